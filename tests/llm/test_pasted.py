"""Passages that units must find wherever they are pasted."""

import random

import pytest

from loamflow.llm import unit_dedup

LETTERS = {
    "plain": "abcdefghijklmnop", "arabic": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي", "hindi": "कखगघचछजझटठडढतथदधनपफबभमयरलवशषसह",
}
HAN = [chr(c) for c in range(0x4E00, 0x4E00 + 2500)]
THAI = [chr(c) for c in range(0x0E01, 0x0E2F)]


def words(rng, n, letters="abcdefghijklmnop"):
    return ["".join(rng.choices(letters, k=rng.randrange(2, 8))) for _ in range(n)]


def passage(rng, kind):
    """A passage of 51 words, or of the characters that make up as many in scripts without blanks."""
    if kind == "names":
        return " ".join(w.capitalize() if rng.random() < 0.4 else w for w in words(rng, 51))
    if kind == "han":
        return "".join(rng.choices(HAN, k=102))
    if kind == "thai":
        return "".join(rng.choices(THAI, k=204))
    return " ".join(words(rng, 51, LETTERS[kind]))


def pasted(rng, kind, text):
    """The passage inside a line of a host in its own script."""
    if kind in ("han", "thai"):
        own = HAN if kind == "han" else THAI
        return "".join(rng.choices(own, k=90)) + text + "".join(rng.choices(own, k=90))
    host = words(rng, 60, LETTERS.get(kind, LETTERS["plain"]))
    return " ".join([*host[:30], text, *host[30:]])


def removed(rows):
    return sum(s.length for s in rows or [])


@pytest.mark.parametrize("kind", ["plain", "names", "arabic", "hindi", "han", "thai"])
def test_passages_without_signs_go_from_any_line(documents, kind):
    rng = random.Random(23)
    texts = [passage(rng, kind) for _ in range(40)]
    rows = [(i + 100 * k, pasted(rng, kind, t)) for k in (0, 1) for i, t in enumerate(texts)]
    out = {r.doc_id: r for r in unit_dedup.remove_repeats(documents(*rows)).collect()}
    assert all(out[i].removed is None for i in range(40))
    shares = [removed(out[100 + i].removed) / len(t) for i, t in enumerate(texts)]
    assert sum(s > 0 for s in shares) >= 39 and sum(shares) / 40 > 0.6 and max(shares) <= 1.02
    assert all(s.kept_doc_id == i for i in range(40) for s in out[100 + i].removed or [])


def test_a_run_counts_whole_though_its_sentences_first_stand_apart(documents):
    rng = random.Random(29)
    sentences = [" ".join(words(rng, 18)).capitalize() + "." for _ in range(3)]
    alone = [(k + 1, f"{' '.join(words(rng, 12))}.\n{s}\n{' '.join(words(rng, 9))}") for k, s in enumerate(sentences)]
    for joint in (" ", "\n"):
        text = joint.join(sentences)
        host = [" ".join(words(rng, 11)) for _ in range(4)]
        both = [(10, f"{host[0]} {text} {host[1]}"), (11, f"{host[2]} {text} {host[3]}")]
        out = {r.doc_id: r for r in unit_dedup.remove_repeats(documents(*alone, *both)).collect()}
        assert all(out[i].removed is None for i in (1, 2, 3, 10))
        assert out[11].text.split() == [*host[2].split(), *host[3].split()]
        assert {s.kept_doc_id for s in out[11].removed} == {10}


def test_short_lines_and_texts_without_blanks_add_up(documents):
    rng = random.Random(31)
    menu = "\n".join(" ".join(words(rng, 3)) for _ in range(20))
    tags = "\n".join(words(rng, 50))
    han = "".join(rng.choices(HAN, k=100))
    code = "".join(rng.choices("abcdef0123456789", k=400))
    rows = [(k + 10 * i, t) for i, t in enumerate((menu, tags, han, code)) for k in (0, 1)]
    rows += [(90, f"one other line of words\n{menu}\nand one behind it")]
    rows += [(91, "\n".join(menu.split("\n")[:8])), (92, han[:40])]  # 24 words and 20: too few
    out = {r.doc_id: r.text for r in unit_dedup.remove_repeats(documents(*rows)).collect()}
    assert {i: out[i] for i in (1, 11, 21, 31)} == {1: "", 11: "", 21: "", 31: ""}
    assert [out[10 * i] for i in range(4)] == [menu, tags, han, code]
    assert out[90] == "one other line of words\nand one behind it"
    assert out[91] == rows[-2][1] and out[92] == rows[-1][1]
