"""SimHash near-duplicates, unit deduplication and decontamination, against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loamflow.llm import decontaminate, simhash, unit_dedup
from loamflow.llm.queries import QUERIES


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# SimHash

def slow_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0D]+", lower(text))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    ones = [sum(xxhash.xxh64_intdigest(s.encode(), 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def slow_components(prints):
    """Index of the first member of each one's component, for fingerprints that link at 2 bits."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 2:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aB é \u0085\n\t\x1c,.ΣK", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_fingerprint_of_long_text():
    text = " ".join(f"Word{k % 997} x{k}" for k in range(200_000))
    words = text.lower().split()
    ones = np.zeros(64, int)
    for i in range(len(words) - 2):
        ones += np.unpackbits(np.array([xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42)], "<u8").view(np.uint8), bitorder="little")
    assert simhash.fingerprint(text) == sum(1 << b for b in range(64) if 2 * ones[b] > len(words) - 2)


def test_simhash_query(spark, sf_dir):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    prints = [slow_fingerprint(t) for _, t in docs]
    roots = slow_components(prints)
    rows = {r.doc_id: r for r in QUERIES["op6_simhash"](spark, sf_dir).collect()}
    for (doc_id, _), fp, root in zip(docs, prints, roots):
        assert rows[doc_id][1:] == (f"{fp:016x}", docs[root][0])


def test_links_find_every_pair_in_chains_and_clusters(spark):
    rng = random.Random(3)
    prints = {0, (1 << 64) - 1, 1 << 63}
    chain = rng.getrandbits(64)
    for step in range(40):  # a chain whose ends are far apart
        chain ^= (1 << (step % 64)) | (1 << ((step * 7 + 13) % 64))
        prints.add(chain)
    for _ in range(4):
        centre = rng.getrandbits(64)
        prints |= {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(60)}
    prints |= {rng.getrandbits(64) for _ in range(200)}
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    roots = slow_components([p & ((1 << 64) - 1) for p in signed])
    found = simhash.rooted(spark.createDataFrame([(p,) for p in signed], "fingerprint long")).collect()
    assert {r.fp: r.root for r in found} == {p: signed[r] for p, r in zip(signed, roots)}


def test_grid_distance_bounds_hamming_distance(spark):
    rng = random.Random(5)
    values = [rng.getrandbits(64) for _ in range(50)]
    rows = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    around = rows.select("fp", simhash.cells_around(simhash.grid_cell(F.col("fp"))).alias("cells")).collect()
    for value, row in zip(values, around):
        digits = [(value >> (2 * i) & 3).bit_count() for i in range(32)]
        cell = sum(d << (2 * i) for i, d in enumerate(digits))
        expected = {cell} | {
            cell + (s << (2 * i)) for i, d in enumerate(digits) for s in (1, -1) if 0 <= d + s <= 2
        }
        assert {c & ((1 << 64) - 1) for c in row.cells} == expected


def test_near_duplicates_of_awkward_rows(awkward):
    rows = simhash.near_duplicates(awkward).collect()
    assert len(rows) == awkward.count()
    zero = {r.doc_id: r.component_id for r in rows if r.fingerprint == "0" * 16}
    assert zero == {2: 2, 3: 2, 4: 2, 7: 2, None: 2}
    kept = simhash.drop_near_duplicates(awkward)
    assert kept.columns == awkward.columns
    ids = sorted((r.doc_id or -1, r.text) for r in kept.select("doc_id", "text").collect() if r.text)
    assert [i for i, _ in ids] == [-1, 1, 1, 5, 6]
    assert [r.doc_id for r in kept.filter("text IS NULL OR trim(text) = ''").collect()] == [2]


def test_near_duplicates_of_nothing(documents):
    none = documents((1, "x")).limit(0)
    assert simhash.near_duplicates(none).count() == 0 and simhash.drop_near_duplicates(none).count() == 0


def test_hot_group_of_copies(documents):
    docs = documents(*[(i, "the very same text of seven words") for i in range(300)], (900, "something else entirely here"))
    assert sorted(r.doc_id for r in simhash.drop_near_duplicates(docs).collect()) == [0, 900]


# Unit deduplication

def sentence(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n)).capitalize() + "."


def slow_spans(docs, min_words=25, unit_words=4):
    """(doc_id, text) -> removed spans, by dictionaries instead of joins."""
    first, rows = {}, {}
    ordered = sorted(set(docs), key=lambda d: ((d[0] is not None, d[0] or 0), xxhash_key(d[1])))
    for doc_id, text in ordered:
        rows[doc_id, text] = list(unit_rows_of(text, unit_words))
        for row in rows[doc_id, text]:
            place = ((doc_id is not None, doc_id or 0), xxhash_key(text), row[2], row[3])
            first[row[5:]] = min(first.get(row[5:], (place, doc_id)), (place, doc_id), key=lambda x: x[0])
    out = {}
    for (doc_id, text), own in rows.items():
        later = [
            dict(zip(("unit", "last_unit", "start", "length", "words"), row), kept_doc_id=first[row[5:]][1]) for row in own
            if ((doc_id is not None, doc_id or 0), xxhash_key(text), row[2], row[3]) != first[row[5:]][0]
        ]
        out[doc_id, text] = unit_dedup.removed_spans(later, min_words)
    return out


def unit_rows_of(text, unit_words):
    return unit_dedup.unit_rows(text or "", unit_words)


def xxhash_key(text):
    if text is None:
        return 42
    value = xxhash.xxh64_intdigest(text.encode(), 42)
    return value - (1 << 64) if value >> 63 else value


def as_spans(row):
    return [(s["start"], s["length"], s["kept_doc_id"]) for s in row or []]


def cut(text, spans):
    out, at = "", 0
    for start, length, _ in spans:
        out, at = out + text[at:start], start + length
    return out + text[at:]


def test_unit_dedup_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    expected = slow_spans(docs)
    texts = dict(docs)
    rows = QUERIES["op7_unit_dedup"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        spans = as_spans(expected[r.doc_id, texts[r.doc_id]])
        assert as_spans(r.removed) == spans
        assert r.text == cut(texts[r.doc_id], spans)


def test_pasted_passages_go_and_clean_texts_stay(documents):
    rng = random.Random(11)
    passage = " ".join(sentence(rng, n) for n in (9, 3, 12, 8, 2, 14, 11))
    rows = []
    for i in range(12):
        body = " ".join(sentence(rng, rng.randrange(3, 14)) for _ in range(12))
        words = body.split()
        if i % 3:  # pasted between two words of a sentence
            at = rng.randrange(5, len(words) - 5)
            body = " ".join([*words[:at], passage, *words[at:]])
        rows.append((i, body))
    out = {r.doc_id: r for r in unit_dedup.remove_repeats(documents(*rows)).collect()}
    for i, body in rows:
        if i % 3 == 0 or i == 1:
            assert out[i].text == body and out[i].removed is None
        else:
            assert passage not in out[i].text and len(out[i].text) <= len(body) - len(passage) + 2
            assert {s.kept_doc_id for s in out[i].removed} == {1}


def test_neighbouring_lines_of_different_documents_stay(documents):
    rng = random.Random(13)
    notices = [sentence(rng, 15) for _ in range(3)]
    docs = documents(*[(i, f"{n}\n{sentence(rng, 9)}") for i, n in enumerate(notices)], (9, "\n".join(notices)))
    assert unit_dedup.remove_repeats(docs).filter("removed IS NOT NULL").count() == 0
    assert unit_dedup.remove_repeats(docs, min_words=15).filter("removed IS NOT NULL").count() == 1


def test_whole_lines_of_short_clauses_go(documents):
    line = "! ".join(f"SHOUT{k}" for k in range(40))
    docs = documents((1, f"first\n{line}\n"), (2, f"second\n{line}\nrest"), (3, "short line.\nanother"), (4, "short line.\nanother"))
    out = {r.doc_id: r.text for r in unit_dedup.remove_repeats(docs).collect()}
    assert out == {1: f"first\n{line}\n", 2: "second\nrest", 3: "short line.\nanother", 4: "short line.\nanother"}


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab AÉ.,!\n\té\U0001f600", max_size=80))
def test_sentences_cover_lines(text):
    at = 0
    for line in unit_dedup._LINE.finditer(text):
        for start, end, words in unit_dedup.sentences(text, *line.span()):
            assert start == at and end > start and words == text[start:end].lower().split()
            at = end
    assert at == len(text)


def test_unit_dedup_of_awkward_rows(awkward, documents):
    out = unit_dedup.remove_repeats(awkward, out="cut")
    assert out.columns == [*awkward.columns, "cut"]
    assert sorted(map(repr, out.filter("cut IS NULL").drop("cut").collect())) == sorted(map(repr, awkward.collect()))
    assert unit_dedup.drop_repeated(awkward).columns == awkward.columns
    with pytest.raises(ValueError):
        unit_dedup.remove_repeats(awkward)
    rng = random.Random(1)
    long = " ".join(sentence(rng, 10) for _ in range(5))
    docs = documents((3, long), (3, long), (4, long), (None, long))
    rows = unit_dedup.remove_repeats(docs).collect()
    assert sorted((r.doc_id or 0, r.text) for r in rows) == [(0, long), (3, ""), (3, ""), (4, "")]
    assert [r.doc_id for r in unit_dedup.drop_repeated(docs).collect()] == [None]
    assert unit_dedup.remove_repeats(docs.limit(0)).count() == 0


# Decontamination

def slow_match(docs, items):
    word = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for name, text in items:
        own = word.findall(lower(text))
        size = min(10, len(own))
        for k in range(len(own) - size + 1 if size else 0):
            windows[tuple(own[k:k + size])].add("null" if name is None else str(name))
    out = []
    for doc_id, text in docs:
        own, hit, names = word.findall(lower(text)), set(), set()
        for size in {len(w) for w in windows}:
            for k in range(len(own) - size + 1):
                found = windows.get(tuple(own[k:k + size]))
                if found:
                    hit |= set(range(k, k + size))
                    names |= found
        out.append((doc_id, len(own), len(hit), sorted(names)))
    return sorted(out, key=repr)


def fast_match(docs, bench, **more):
    rows = decontaminate.match(docs, bench, **more).collect()
    return sorted(((r.doc_id, r.n_words, sum(s.length for s in r.hits), r["items"]) for r in rows), key=repr)


def test_winnowing_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    rows = QUERIES["op9_winnowing"](spark, sf_dir).collect()
    expected = [
        (d, n, h, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), h > 0) for d, n, h, names in slow_match(docs, items)
    ]
    assert sorted(map(tuple, rows)) == sorted(expected)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10_000))
def test_winnowing_of_dense_texts(spark, documents, seed):
    """Two or three different words: windows repeat, tie and overlap everywhere."""
    rng = random.Random(seed)

    def text(n):
        return " ".join(rng.choices(["a", "B", "é,"], k=rng.randrange(n)))

    docs = [(i, text(60)) for i in range(12)]
    items = [(i % 7, text(25)) for i in range(10)] + [(None, text(14)), (8, None), (9, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert fast_match(documents(*docs), bench) == slow_match(docs, items)


def test_winnowing_in_blocks(spark, documents, awkward):
    rng = random.Random(2)
    vocabulary = [f"w{k}" for k in range(300)]
    items = [(i, " ".join(rng.choices(vocabulary, k=30))) for i in range(20)]
    docs = [(i, " ".join([items[i % 20][1][5:], "and", items[(i * 3) % 20][1]]) if i % 2 else "clean text") for i in range(10)]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("hits", F.lit(1))
    assert fast_match(documents(*docs), bench, block_bytes=700) == slow_match(docs, items)
    kept = decontaminate.drop_contaminated(documents(*docs), bench, block_bytes=700)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 4, 6, 8]
    assert sorted(map(repr, decontaminate.drop_contaminated(awkward, bench).collect())) == sorted(map(repr, awkward.collect()))
    assert fast_match(awkward, bench.limit(0)) == slow_match([(r.doc_id, r.text) for r in awkward.collect()], [])
    assert decontaminate.match(awkward.limit(0), bench).count() == 0


@pytest.mark.parametrize("n", [6, 10, 50])
def test_kept_hashes_of_equal_windows_agree(n):
    rng = np.random.default_rng(n)
    hashes = rng.integers(0, 4, n).astype(np.uint64)
    kept = set(decontaminate.winnowed(hashes).tolist())
    for k in range(n - decontaminate.SPAN + 1):
        window = hashes[k:k + decontaminate.SPAN]
        assert {k + i for i in range(len(window)) if window[i] == window.min()} <= kept


def test_units_that_do_not_repeat_are_left_out_before_the_join(spark, documents, monkeypatch):
    rng = random.Random(11)
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(i, " ".join(f"w{rng.randrange(10**9)}" for _ in range(600)) + (f" {passage}" if i % 20 == 0 else "")) for i in range(200)]
    lookup_join, sent = unit_dedup.lookup_join, []

    def joined(left, right, keys, how):
        if keys == ["d1"]:
            sent.append((left.count(), left.join(right, "d1", "left_semi").count()))
        return lookup_join(left, right, keys, how)

    monkeypatch.setattr(unit_dedup, "lookup_join", joined)
    out = {r.doc_id: r.removed for r in unit_dedup.remove_repeats(documents(*rows)).collect()}
    assert {i for i, spans in out.items() if spans} == {i for i, _ in rows if i % 20 == 0 and i}
    # Two thousand units and more are hashed; the map lets few through that do not repeat.
    (through, repeated), = sent
    assert 0 < repeated <= through < repeated + 1000


def test_a_full_map_loses_no_repeat(documents, monkeypatch):
    monkeypatch.setattr(unit_dedup, "MOST_WORDS", 1)
    passage = " ".join(f"p{k}" for k in range(60))
    out = unit_dedup.remove_repeats(documents((1, f"one {passage} end"), (2, f"two {passage} too"))).collect()
    assert [bool(r.removed) for r in sorted(out, key=lambda r: r.doc_id)] == [False, True]


def slow_runs(text, unit_words, min_words):
    """start, length, words and digest of the shortest runs from each unit on and up to each unit."""
    units, at = [], 0
    for piece in unit_dedup.pieces(text):
        units += [(a, w) for a, _, w in unit_dedup.sentences(text, at, at + len(piece), unit_words) if w]
        at += len(piece)
    ends, found = [*[a for a, _ in units[1:]], len(text)], set()

    def shortest(spans):
        for i, j in spans:
            words = [w for _, own in units[i:j + 1] for w in own]
            if len(words) >= min_words:
                value = xxhash.xxh3_128_intdigest(" ".join(words).encode())
                found.add((units[i][0], ends[j] - units[i][0], len(words), (value >> 64) - (1 << 63), (value & ((1 << 64) - 1)) - (1 << 63)))
                return

    for k in range(len(units)):
        shortest((k, j) for j in range(k, len(units)))
        shortest((i, k) for i in range(k, -1, -1))
    return found


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab AÉİ.,!\n\té\x1c\u0085\U0001f600", max_size=150), st.sampled_from([7, 40, 1 << 20]), st.sampled_from([1, 3, 9]))
def test_runs_of_pieces_are_those_of_the_whole(text, size, min_words):
    with pytest.MonkeyPatch.context() as patch:
        pieces = unit_dedup.pieces
        patch.setattr(unit_dedup, "pieces", lambda t: pieces(t, size))
        rows = [r[2:] for r in unit_dedup.unit_rows(text, 4, min_words)]
        assert len(rows) == len(set(rows)) and set(rows) == slow_runs(text, 4, min_words)


def test_units_are_deleted_once_the_shared_ones_are_settled(documents):
    from loamflow.llm import base

    known, passage = set(base.SCRATCH), " ".join(f"p{k}" for k in range(60))
    out = unit_dedup.remove_repeats(documents((1, f"one {passage} end"), (2, f"two {passage} too")))
    left = {p.rsplit("/", 1)[-1].rsplit("-", 1)[0] for p in base.SCRATCH if p not in known}
    assert "shared-units" in left and not left & {"units", "often"}
    assert [bool(r.removed) for r in sorted(out.collect(), key=lambda r: r.doc_id)] == [False, True]
