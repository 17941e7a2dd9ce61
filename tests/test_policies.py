import pytest
from pyspark.sql import functions as F

from compare import bag
from loamflow import GovernanceEngine
from loamflow.operators import policies

PEOPLE = [(1, "Ann", "Ann Lee", "ann@x.org", "+1 (555) 123-4567", "1 Main St"), (2, None, None, None, None, None)]
COLUMNS = "id INT, first_name STRING, full_name STRING, email STRING, phone STRING, address STRING"
KINDS = {"first_name": "name", "full_name": "full_name", "email": "email", "phone": "phone", "address": "address"}


def test_masks(spark):
    hidden = bag(policies.mask_columns(spark.createDataFrame(PEOPLE, COLUMNS), KINDS))
    assert hidden == [
        (1, "A***", "Ann ***", "ann@***.***", "*******4567", "*** REDACTED ***"),
        (2, None, None, None, None, "*** REDACTED ***"),
    ]


@pytest.mark.parametrize(
    "phone, shown", [("12", "12"), ("", ""), ("UNKNOWN", "UNKNOWN"), ("12345", "*2345"), ("n/a", ""), (None, None)]
)
def test_phone_mask_edges(spark, phone, shown):
    df = spark.createDataFrame([(phone,)], "phone STRING")
    assert policies.mask_columns(df, {"phone": "phone"}).first()[0] == shown


def test_privileged_sees_raw_values(spark):
    df = spark.createDataFrame(PEOPLE, COLUMNS)
    assert bag(policies.mask_columns(df, KINDS, True)) == bag(df)
    by_row = policies.mask_columns(df, {"first_name": "name"}, F.col("id") != 1)
    assert [r["first_name"] for r in by_row.orderBy("id").collect()] == ["A***", None]


def test_mask_that_cannot_be_applied_raises(spark):
    df = spark.createDataFrame(PEOPLE, COLUMNS)
    with pytest.raises(ValueError, match="cannot mask"):
        policies.mask_columns(df, {"nope": "name"})
    with pytest.raises(Exception, match="no_such_function"):
        policies.mask_columns(df, {"email": "no_such_function"})


MAPPING = [("sales_eu", ["1", "2"]), ("sales_us", ["2", "3"]), ("other", ["9"]), ("sales_eu", None)]


@pytest.mark.parametrize(
    "groups, seen",
    [(["sales_eu"], [1, 2]), (["sales_eu", "sales_us"], [1, 2, 3]), (["nobody"], []), ([], []), (["boss"], [1, 2, 3, 4, None])],
)
def test_row_filter(spark, groups, seen):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,), (None,)], "branch INT")
    mapping = spark.createDataFrame(MAPPING, "user_group STRING, allowed_branch_codes ARRAY<STRING>")
    visible = policies.row_filter(df, "branch", mapping, groups, admin_group="boss")
    assert [r[0] for r in bag(visible)] == seen


def test_row_filter_without_mapping_shows_nothing(spark):
    assert policies.row_filter(spark.range(3), "id", None, ["sales_eu"]).count() == 0


POLICY = {
    "table_tags": {"domain": "retail", "env": "test"},
    "pii_columns": [
        {"column": "first_name", "pii_type": "NAME", "abac_tag_key": "pii", "abac_tag_value": "name",
         "masking_function": "hide_first", "masking_sql":
             "CREATE OR REPLACE TEMPORARY FUNCTION hide_first(v STRING) RETURN concat(left(v, 1), '...')"},
        {"column": "email", "pii_type": "EMAIL", "masking_function": "email"},
        {"column": "address", "pii_type": "", "abac_tag_value": ""},
    ],
    "column_tags": [{"column": "id", "tags": {"is_pk": "true", "note": ""}}],
    "row_level_security": {"enabled": True, "filter_column": "id", "admin_group": "boss"},
}


def test_tag_inventory(spark):
    tags = GovernanceEngine(spark, POLICY, "sales.people").tags()
    assert bag(tags.drop("table_name").na.fill("-", ["column_name"])) == sorted([
        ("-", "domain", "retail"), ("-", "env", "test"),
        ("first_name", "pii", "name"), ("first_name", "pii_type", "NAME"), ("first_name", "sensitivity", "high"),
        ("email", "pii", "email"), ("email", "pii_type", "EMAIL"), ("email", "sensitivity", "high"),
        ("address", "sensitivity", "high"), ("id", "is_pk", "true"),
    ])


def test_policy_view(spark):
    engine = GovernanceEngine(spark, POLICY, "sales.people")
    mapping = spark.createDataFrame([("team", ["1"])], "user_group STRING, allowed_branch_codes ARRAY<STRING>")
    df = spark.createDataFrame(PEOPLE, COLUMNS)
    shown = engine.visible(df, False, ["team"], mapping)
    assert bag(shown.select("id", "first_name", "email")) == [(1, "A...", "ann@***.***")]
    assert engine.visible(df, True, ["boss"]).count() == 2
    assert "python" not in shown._jdf.queryExecution().optimizedPlan().toString().lower()


def test_tags_survive_parquet_and_drive_masks(spark, tmp_path):
    df = spark.createDataFrame(PEOPLE, COLUMNS)
    tagged = policies.with_column_tags(df, {c: {"pii": k} for c, k in KINDS.items()})
    tagged.write.parquet(str(tmp_path / "people"))
    stored = spark.read.parquet(str(tmp_path / "people"))
    assert policies.column_tags(stored) == {c: {"pii": k} for c, k in KINDS.items()}
    assert bag(policies.mask_by_tag(stored)) == bag(policies.mask_columns(df, KINDS))
    with pytest.raises(ValueError, match="no mask"):
        policies.mask_by_tag(policies.with_column_tags(df, {"email": {"pii": "iris_scan"}}))


def statement(name, body="concat(left(v, 1), '!')", args="(v STRING)"):
    return f"CREATE OR REPLACE FUNCTION {name}{args} RETURN {body}"


@pytest.mark.parametrize("called", ["main.gov.hide", "gov.hide", "hide", "`MAIN`.gov.`Hide`", "other.main.gov.hide"])
def test_functions_are_found_under_every_form_of_their_name(spark, called):
    with policies.SqlFunctions(spark, [statement("main.gov.hide"), statement("main.gov.hide_more", "'?'")]) as functions:
        shown = policies.mask_columns(spark.createDataFrame(PEOPLE, COLUMNS), {"email": functions.resolve(called)})
    assert [r["email"] for r in shown.orderBy("id").collect()] == ["a!", None]
    assert not [f.name for f in spark.catalog.listFunctions() if f.name.startswith("__policy_")]


def test_names_that_fit_several_statements_or_none(spark):
    with policies.SqlFunctions(spark, [statement("a.x.hide"), statement("b.y.hide", "'?'")]) as functions:
        with pytest.raises(ValueError, match="several"):
            functions.resolve("hide")
        assert functions.resolve("y.hide") != functions.resolve("x.hide")
        assert functions.resolve("elsewhere") == "elsewhere"
    with pytest.raises(ValueError, match="CREATE FUNCTION"):
        policies.SqlFunctions(spark, ["DROP TABLE x"])
    with pytest.raises(Exception, match="nope"):
        with policies.SqlFunctions(spark, [statement("a.b.ok"), statement("a.b.bad", "nope(v)")]):
            pass
    assert not [f.name for f in spark.catalog.listFunctions() if f.name.startswith("__policy_")]


@pytest.mark.parametrize("groups, principal, shown", [
    (["hr"], "x", "Ann"), ([], "it's me", "Ann"), ([], "x", "A!"), (["hr2"], None, "A!"),
])
def test_membership_and_user_inside_a_function(spark, groups, principal, shown):
    body = """CASE WHEN IS_ACCOUNT_GROUP_MEMBER('hr') OR current_user() = "it's me" THEN v ELSE concat(left(v, 1), '!') END"""
    policy = {"pii_columns": [{"column": "first_name", "masking_function": "hide", "masking_sql": statement("m.g.hide", body)}]}
    seen = policies.govern(spark.createDataFrame(PEOPLE[:1], COLUMNS), policy, False, groups, None, principal)
    assert seen.first()["first_name"] == shown


def test_a_boolean_function_filters_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (None, "a")], "id INT, kind STRING")
    security = {"enabled": True, "rls_function_name": "g.own", "filter_columns": ["id", "kind"], "admin_group": "boss",
                "function_sql": statement("m.g.own", "i < 3 AND k = 'a'", "(i INT, k STRING)")}
    policy = {"row_level_security": security}
    assert [r.id for r in policies.govern(df, policy, False, ["team"]).collect()] == [1]
    assert policies.govern(df, policy, False, ["boss"]).count() == 4
    with pytest.raises(ValueError, match="not boolean"):
        security["function_sql"] = statement("m.g.own", "i", "(i INT, k STRING)")
        policies.govern(df, policy, False, ["team"])
    with pytest.raises(Exception, match="unknown"):
        security["rls_function_name"] = "unknown"
        policies.govern(df, policy, False, ["team"])
