"""Near duplicates against a comparison of all pairs of shingle sets."""

import random
import re

import numpy as np
import pytest
from helpers import awkward_documents, documents, prose

from mirrorflow.llm import minhash
from mirrorflow.llm.components import connected_components, spanning_links
from mirrorflow.llm.shingles import shingle_set


def plain_set(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute_force(rows, percent):
    """doc_id, n_shingles, component_id, kept of each row."""
    known = [(i, plain_set(t)) for i, t in rows]
    usable = [n for n, (i, s) in enumerate(known) if i is not None and s]
    root = list(range(len(known)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, x in enumerate(usable):
        for y in usable[n + 1 :]:
            a, b = known[x][1], known[y][1]
            both = len(a & b)
            if 100 * both >= percent * (len(a) + len(b) - both):
                root[max(find(x), find(y))] = min(find(x), find(y))
    least = {}
    for x in usable:
        least[find(x)] = min(known[x][0], least.get(find(x), known[x][0]))
    out = []
    for x, (i, s) in enumerate(known):
        c = least.get(find(x), i)
        out.append((i, len(s), c, i is None or c == i))
    return sorted(out, key=str)


def found(df, percent):
    return sorted((tuple(r) for r in minhash.near_duplicates(df, percent=percent).collect()), key=str)


def edited(text, rnd, share):
    return " ".join(f"e{rnd.randrange(10**6)}" if rnd.random() < share else w for w in text.split(" "))


def corpus():
    rnd = random.Random(4)
    rows, passage = [], prose(999, 80, 10**6)
    for g in range(12):
        base = prose(g, rnd.randint(60, 300), 10**6)
        for _ in range(rnd.randint(1, 9)):
            rows.append(edited(base, rnd, rnd.choice([0, 0.004, 0.01, 0.02, 0.04])))
    # a large group whose members are near the limit of each other, and texts that share a passage
    base = prose(77, 250, 10**6)
    rows += [edited(base, rnd, 0.012) for _ in range(90)]
    rows += [f"{prose(500 + i, 30, 10**6)} {passage}" for i in range(40)]
    rnd.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("percent", [80, 85])
def test_against_all_pairs(spark, percent, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 16)
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(df, percent) == brute_force(rows, percent)


def test_nothing_that_grows_is_broadcast(spark, monkeypatch):
    """Spark takes these tables for small, and the exploded signatures for no larger than the classes."""
    rows = corpus()
    df = spark.createDataFrame(rows + rows[:3], "doc_id long, text string")
    plans, write, components = {}, minhash.materialise, minhash.connected_components

    def planned(table, name):
        plans[name] = table._jdf.queryExecution().executedPlan().toString()
        return table

    monkeypatch.setattr(minhash, "materialise", lambda table, name: write(planned(table, name), name))
    monkeypatch.setattr(minhash, "connected_components", lambda links: components(planned(links, "found")))
    for run in (minhash.near_duplicates, minhash.without_near_duplicates):
        plans.clear()
        planned(run(df), "result")
        joined = {name for name, plan in plans.items() if "SortMergeJoin" in plan}
        want = {"postings", "joint", "home_links", "placed", "listed", "block_pairs", "found", "class_roots"}
        assert joined >= want | {"result"}
        for name, plan in plans.items():
            assert not re.search("Broadcast(Hash|NestedLoop)Join", plan), name


def test_awkward_rows(spark):
    rows = awkward_documents()
    assert found(documents(spark, rows), 85) == brute_force([r[:2] for r in rows], 85)


def test_unlike_texts_under_one_id(spark):
    """They are classes of their own, whatever other rows either of them is like."""
    a, b = prose(1, 80, 10**6), prose(2, 80, 10**6)
    rows = [(2, a), (2, b), (1, b + " more"), (3, a), (2, a), (4, prose(3, 80, 10**6)), (4, prose(4, 80, 10**6))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = found(df, 85)
    assert got == brute_force(rows, 85)
    assert [r[2:] for r in got if r[0] == 2] == [(1, False), (2, True), (2, True)]


def test_one_row_of_each_group(spark):
    """Groups are judged by rows: no unlike text goes, and no group leaves two rows."""
    rnd = random.Random(8)
    texts = [prose(i, 60, 10**6) for i in range(6)]
    rows = [(1, texts[0], 5), (1, texts[0], 3), (1, texts[1], 1), (2, texts[1], 1), (None, texts[2], 1), (None, texts[2], 1)]
    rows += [(None, texts[3], 1), (7, texts[3], 2), (None, texts[0], 0), (3, "", 1), (3, "", 1), (None, None, 1), (4, texts[4], 1)]
    rows += [(None, texts[5], 2), (None, texts[5] + " more", 1)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, `a.b` int")
    got = sorted((tuple(r) for r in minhash.without_near_duplicates(df).collect()), key=str)
    want = [(1, texts[0], 3), (1, texts[1], 1), (None, texts[2], 1), (7, texts[3], 2), (4, texts[4], 1)]
    want += [(3, "", 1), (3, "", 1), (None, None, 1)]
    last = [r for r in got if r[0] is None and r[1] and r[1].startswith(texts[5])]
    assert len(last) == 1
    assert [r for r in got if r not in last] == sorted(want, key=str)
    assert minhash.without_near_duplicates(df.limit(0)).count() == 0


def test_given_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert found(df, 85) == brute_force(rows, 85)


def test_empty_table(spark):
    assert found(spark.createDataFrame([], "doc_id long, text string"), 85) == []


def test_shingle_sets():
    assert len(shingle_set("a b c d e f")) == 2 and len(shingle_set("a a a a a a a")) == 1
    assert (shingle_set("A b\tc\x0bD  e") == shingle_set("a B c d E")).all()
    assert len(shingle_set("a b")) == 1 and shingle_set("a b")[0] != shingle_set("b a")[0]
    assert len(shingle_set(None)) == len(shingle_set(" \n")) == 0
    assert (shingle_set("a b c") == shingle_set("a b\nc")).all()


def test_match_threshold_misses_little():
    for percent in (80, 85, 95):
        t, p = minhash.match_threshold(percent), percent / 100
        rng = np.random.default_rng(1)
        assert (rng.binomial(minhash.COORDINATES, p, 200_000) >= t).all()


def test_dense_and_sparse_comparison_agree():
    rng = np.random.default_rng(2)
    base = rng.choice(2**40, 200, replace=False).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[rng.random(200) < 0.93], rng.integers(0, 2**40, 5).astype(np.uint64)])) for _ in range(30)]
    sigs = np.zeros((30, 4), np.int32)
    links = minhash.block_links(list(range(30)), sigs, sets, 30, 1, 85)
    want = [
        (i, j) for i in range(30) for j in range(i + 1, 30)
        if 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))
    ]
    assert len(want) > 64

    def components(pairs):
        x, y = np.array(pairs).T
        return dict(zip(*map(list, spanning_links(30, x, y))))

    assert components(links) == components(want)


def test_connected_components(spark):
    rnd = random.Random(1)
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + rnd.randrange(1, 50)) for _ in range(60)]
    pairs += [(200, 200), (None, 3), (300, 299), (301, 300), (299, 301)]
    out = connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()
    got = {r.id: r.component for r in out}
    assert all(got[i] == 0 for i in range(41)) and got[301] == 299 and 200 not in got
    assert {got[b] for a, b in pairs[40:100]} == {100}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
