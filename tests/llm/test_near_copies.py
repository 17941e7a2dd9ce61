"""Near copies by shingle similarity, with planted copies around 0.8."""

import random

from loamflow.llm import near_copies, simhash


def planted(n_pairs, seed=17):
    """(doc_id, text) rows: a text at 2 i and its copy with random words replaced at 2 i + 1."""
    rng, rows = random.Random(seed), []
    for i in range(n_pairs):
        words = [f"w{rng.randrange(20_000)}" for _ in range(rng.randrange(150, 600))]
        copy = list(words)
        for at in rng.sample(range(len(words)), max(1, round(len(words) * rng.choice([0, 0.005, 0.01, 0.015, 0.02, 0.03, 0.05])))):
            copy[at] = f"x{rng.randrange(20_000)}"
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(copy))]
    return rows


def sets(rows):
    out = {}
    for i, text in rows:
        words = text.lower().split()
        out[i] = {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))}
    return out


def test_planted_copies_from_four_fifths_on_go_and_others_stay(documents):
    rows = planted(120)
    own = sets(rows)
    near = {i for i in own if i % 2 and len(own[i] & own[i - 1]) >= 0.8 * len(own[i] | own[i - 1])}
    assert 60 < len(near) < 115
    kept = {r.doc_id for r in simhash.drop_near_duplicates(documents(*rows), similarity=0.8).collect()}
    assert set(own) - kept == near


def test_shingles_of_pieces_and_short_texts(monkeypatch):
    text = " ".join(f"a{k}" for k in range(400))
    whole = near_copies.shingles(text).tolist()
    assert len(whole) == 396
    monkeypatch.setattr(near_copies, "pieces", lambda t: [t[:800], t[800:]] if t[799] == " " else [t[:t.index(" ", 800) + 1], t[t.index(" ", 800) + 1:]])
    assert near_copies.shingles(text).tolist() == whole
    monkeypatch.undo()
    assert len(near_copies.shingles("one Two")) == 1 and not len(near_copies.shingles(None))


def test_copies_in_a_hot_group(documents):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(300)]
    rows = [(i, " ".join(words[:k] + [f"y{i}"] + words[k:])) for i in range(200) for k in [rng.randrange(300)]]
    assert [r.doc_id for r in simhash.drop_near_duplicates(documents(*rows), similarity=0.8).collect()] == [0]


def test_stage_on_the_given_table(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    own = {i: s if text.split() else set() for (i, text), s in zip(rows, sets(rows).values())}
    root = {i: i for i in own}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in own:
        for j in own:
            if j < i and len(own[i] & own[j]) >= 0.8 * len(own[i] | own[j]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    kept = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir).collect()}
    assert kept == {find(i) for i in own}


def template_family(n, seed=23):
    """(doc_id, text): texts of one template, alike at about 0.6; every tenth has a near copy of over 0.8."""
    rng, rows = random.Random(seed), []
    template = [f"t{k}" for k in range(400)]
    for i in range(n):
        words = list(template)
        for at in rng.sample(range(0, 400, 5), 22):
            words[at] = f"own{i}x{at}"
        rows.append((len(rows), " ".join(words)))
        if i % 10 == 0:
            for at in rng.sample(range(0, 400, 5), 6):
                words[at] = f"copy{i}x{at}"
            rows.append((len(rows), " ".join(words)))
    return rows


def test_no_link_is_lost_in_a_template_family(documents):
    rows = template_family(600)
    own = sets(rows)
    near = [(i, j) for i in own for j in own if j < i and len(own[i] & own[j]) >= 0.8 * len(own[i] | own[j])]
    assert 50 < len(near) < 70 and {i - j for i, j in near} == {1}
    kept = {r.doc_id for r in simhash.drop_near_duplicates(documents(*rows), similarity=0.8).collect()}
    assert set(own) - kept == {i for i, _ in near}


def test_awkward_rows_and_empty_tables(documents, awkward):
    prints = near_copies.prints(awkward)
    assert {r.size for r in prints.collect()} >= {0, 1}
    assert near_copies.links(awkward, prints, 0.8).count() == 0
    empty = documents((1, "a")).limit(0)
    assert near_copies.links(empty, near_copies.prints(empty), 0.8).count() == 0


def test_texts_within_two_simhash_bits_meet_without_a_common_band(documents, monkeypatch):
    from pyspark.sql import functions as F

    words = [f"w{k}" for k in range(3000)]
    rows = [(1, " ".join(words)), (2, " ".join([*words, "end"])), (3, " ".join(f"other{k}" for k in range(3000)))]
    prints = near_copies.prints
    monkeypatch.setattr(near_copies, "prints", lambda docs: prints(docs).withColumn("bands", F.array("fingerprint")))
    assert {r.doc_id for r in simhash.drop_near_duplicates(documents(*rows), similarity=0.8).collect()} == {1, 3}


def edited_family(n, seed=29):
    """(doc_id, text): a text of 140 words, each time with other words replaced, a few or many."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        words = [f"t{k}" for k in range(140)]
        for at in rng.sample(range(140), rng.randrange(1, 12)):
            words[at] = f"own{i}x{at}"
        rows.append((i, " ".join(words)))
    return rows


def test_a_family_of_edited_copies_costs_a_few_rows_for_each_text(documents, monkeypatch):
    rows = edited_family(500)
    own = sets(rows)
    root = list(own)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in own:
        for j in range(i):
            if len(own[i] & own[j]) >= 0.8 * len(own[i] | own[j]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    compared, settle = [], near_copies.settle

    def counted(df, name):
        out = settle(df, name)
        compared.append((name, out.count()))
        return out

    monkeypatch.setattr(near_copies, "settle", counted)
    kept = {r.doc_id for r in simhash.drop_near_duplicates(documents(*rows), similarity=0.8).collect()}
    whole = {find(i) for i in own}
    # Min-hashing proves no link found: 1 of 500 such texts was lost with this seed.
    assert whole <= kept and len(kept - whole) <= 2 < 100 < len(rows) - len(whole)
    assert sum(n for name, n in compared if name == "near-pairs") < 60 * len(rows), compared
    assert max(n for _, n in compared) < 100 * len(rows), compared


def test_a_later_round_only_asks_where_the_other_text_is_new(documents, monkeypatch):
    rows, rounds, asked = edited_family(500), [], []
    settle, lookup_join = near_copies.settle, near_copies.lookup_join

    def settled(df, name):
        out = settle(df, name)
        if name == "near-apart":
            rounds.append(out.count())
        return out

    def joined(left, right, keys, how):
        out = lookup_join(left, right, keys, how)
        if how == "inner" and "other" in right.columns and "hub" in left.columns:
            asked.append(out.count())
        return out

    monkeypatch.setattr(near_copies, "settle", settled)
    monkeypatch.setattr(near_copies, "lookup_join", joined)
    simhash.drop_near_duplicates(documents(*rows), similarity=0.8)
    assert len(rounds) == len(asked) >= 2 and sum(rounds[1:]) > 0
    assert sum(asked[1:]) < sum(rounds[1:]), (rounds, asked)


def test_roots_are_looked_up_for_texts_not_for_each_of_their_keys(documents, monkeypatch):
    rows, placed, asked = template_family(600), [], []
    lookup_join = near_copies.lookup_join

    def joined(left, right, keys, how):
        out = lookup_join(left, right, keys, how)
        if how == "left":
            placed.append(out.count())
        if how == "left_anti" and keys == ["u", "v"]:
            asked.append((left.count(), left.distinct().count()))
        return out

    monkeypatch.setattr(near_copies, "lookup_join", joined)
    simhash.drop_near_duplicates(documents(*rows), similarity=0.8)
    assert placed and sum(placed) < 6 * len(rows), placed
    assert all(n == distinct for n, distinct in asked)
