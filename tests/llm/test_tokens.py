"""Encoder, packing and the token store, against the tokenizers library on whole texts."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from loamflow.llm import base, packing, token_store
from loamflow.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text, end: np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [end], "<u4").tobytes()


_ENCODER = []
_PLAIN = []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(
    st.text(max_size=12), st.sampled_from([
        "don't", "We'LL", "''s", "İ", "ΑΣ", "e\u0301", "\u0301x", "½²", "a_b", "x\u00a0y", "ﬁ", "<|endoftext|>", "1234", "ÀÉ,", "...",
    ]),
)).map(" ".join))
def test_encoder_equals_the_library_on_whole_texts(text):
    if not _ENCODER:
        _ENCODER.append(base.TokenIds(PATH, limit=50, chunk_limit=20))
        _PLAIN.append(Tokenizer.from_file(PATH))
        _PLAIN[0].encode_special_tokens = True
    expected = np.array(_PLAIN[0].encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert _ENCODER[0](text) == expected


def test_pieces_cover_the_text():
    text = "ab cd\nef " * 1000 + "x" * 500
    cut = list(base.pieces(text, 100))
    assert "".join(cut) == text and max(map(len, cut[:-1])) < 120
    assert list(base.pieces("", 10)) == [""]


def check_pieces(rows, docs, plain):
    """Every id of every document lies in one piece; windows are gapless; returns the padding share."""
    by_doc, by_window = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id, r.doc_tokens].append(r)
        by_window[r.sequence_id].append(r)
    expected = defaultdict(list)
    for doc_id, text in docs:
        ids = plain(text, 2)
        expected[doc_id, len(ids) // 4].append(ids)
    assert set(by_doc) == set(expected)
    for key, pieces in by_doc.items():
        cover = np.zeros(key[1], int)
        for p in pieces:
            cover[p.start:p.start + p.length] += 1
            cut = [zlib.crc32(ids[4 * p.start:4 * (p.start + p.length)]) for ids in expected[key]]
            assert p.ids_crc32 in cut
        assert (cover == len(expected[key])).all()
    padding = total = 0
    for pieces in by_window.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 4096
        total += at
        padding += 0 if at & (at - 1) == 0 else 4096 - at
    return padding / max(1, total)


def test_packing_query(spark, sf_dir, plain):
    docs = [(r.doc_id, r.text) for r in base.table(spark, sf_dir, "documents").collect()]
    frame = QUERIES["op1_packing"](spark, sf_dir)
    assert check_pieces(frame.collect(), docs, plain) < 0.001


def test_packing_of_awkward_rows(awkward, plain):
    rows = packing.pack_documents(awkward.repartition(3), PATH, with_ids=True).collect()
    check_pieces(rows, [(r.doc_id, r.text) for r in awkward.collect()], plain)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in rows)


def test_step_groups_hold_equal_tokens(awkward):
    rows = packing.pack_documents(awkward, PATH, step_tokens=8192).collect()
    groups = defaultdict(dict)
    for r in rows:
        groups[r.window, r.step_group][r.sequence_id] = r.window
    for (window, group), windows in groups.items():
        last = group == max(g for w, g in groups if w == window)
        assert sum(windows.values()) == 8192 or last


def test_small_pool_gives_full_windows():
    packer = packing.Packer(0, packing.TIERS, 5000)
    rng = np.random.default_rng(0)
    rows = []
    for doc in range(400):
        rows += packer.add(doc, b"\1\0\0\0" * int(rng.integers(1, 3000)))
    rows += packer.finish()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[5], r[7]] += r[2]
    assert all(size == window for (_, window), size in sizes.items())
    assert sum(size < 512 for size in sizes.values()) <= 9


def test_packing_rejects_bad_tiers(awkward):
    with pytest.raises(ValueError):
        packing.pack_documents(awkward, PATH, tiers=(500, 4096))
    with pytest.raises(ValueError):
        packing.pack_documents(awkward, PATH, step_tokens=5000)


def test_empty_table(spark, documents, tmp_path):
    none = documents((1, "x")).limit(0)
    assert packing.pack_documents(none, PATH).count() == 0
    token_store.write_store(none, f"{tmp_path}/store", PATH)
    assert token_store.read_store(spark, f"{tmp_path}/store").count() == 0


def test_planes_round_trip():
    ids = np.random.default_rng(1).integers(0, 49408, 1000).astype("<u4").tobytes()
    planes = token_store.to_planes(ids)
    assert len(planes) == 4 and len(planes[3]) < 30
    assert token_store.from_planes(planes, 1000) == ids


def test_token_store_query(spark, sf_dir, plain):
    docs = sorted((r.doc_id, r.text) for r in base.table(spark, sf_dir, "documents").collect())
    rows = {r.doc_id: r for r in QUERIES["op3_token_store"](spark, sf_dir).collect()}
    start = 0
    for doc_id, text in docs:
        ids = plain(text, 1)
        assert rows[doc_id][1:4] == (start, len(ids) // 4, zlib.crc32(ids))
        start += len(ids) // 4


@pytest.mark.parametrize("block_ids", [7, 1 << 17])
def test_token_store_of_awkward_rows(spark, awkward, plain, tmp_path, block_ids):
    path = f"{tmp_path}/store"
    docs = awkward.filter("doc_id IS NULL OR doc_id < 6")
    token_store.write_store(docs, path, PATH, block_ids=block_ids, shards=3)
    rows = sorted(tuple(r) for r in token_store.read_store(spark, path).select("start", "n_tokens", "ids_crc32").collect())
    keyed = docs.select("doc_id", "text", base.text_key().alias("text_key")).collect()
    at, expected = 0, []
    for _, text, _ in sorted(keyed, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text_key)):
        ids = plain(text, 1)
        expected.append((at, len(ids) // 4, zlib.crc32(ids)))
        at += len(ids) // 4
    assert rows == expected


def test_plain_texts_are_looked_up_word_by_word():
    encoder = base.TokenIds(PATH)
    plain = "It's a plain text, isn't it? ÉTÉ Ɓa ɃƵ 42 a_b--c 'tis \"'s\n" * 3
    odd = "İstanbul Ⱥb Ⱦc 文字 plain\twords"
    for text in (plain, odd, f"{plain} {odd}"):
        assert encoder(text) == base._le(encoder.tokenizer.encode(text, add_special_tokens=False).ids)
    encoder = base.TokenIds(PATH)
    encoder(plain)
    assert set(encoder.chunks) == {""} and {"plain", "été"} <= set(encoder.words)
