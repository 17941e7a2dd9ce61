import pytest
from hypothesis import given
from hypothesis import strategies as st

from loamflow import to_snake_case


@pytest.mark.parametrize(
    "name, expected",
    [
        ("unitPrice", "unit_price"),
        ("XMLParserName", "xml_parser_name"),
        ("Ship Date", "ship_date"),
        ("line-no", "line_no"),
        ("tax.rate", "tax_rate"),
        ("__edge__", "edge"),
        ("a___b", "a_b"),
        ("SKU", "sku"),
        ("route66Name", "route66_name"),
        ("Q7Z", "q7_z"),
        ("ZZ9q", "zz9q"),
        ("p#Q", "p#q"),
    ],
)
def test_snake_case(name, expected):
    assert to_snake_case(name) == expected


@given(st.text(alphabet="aB1 _-.", max_size=12))
def test_snake_case_twice_is_once(name):
    once = to_snake_case(name)
    assert to_snake_case(once) == once
    assert once == once.lower() and "__" not in once and once == once.strip("_")
