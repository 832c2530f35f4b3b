"""Hash trees and the climb of every row against plain Python."""

import hashlib
import itertools
import zlib

import pytest
from helpers import DOCUMENTS, against_sql, awkward_documents, documents, written

from mirrorflow.llm import merkle

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = (row[0], row[3], row[2], row[4], text)
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(nodes):
    """Root digest of a list of (digest, members); members get their proof and folded digest."""
    while len(nodes) > 1:
        above = []
        for start in range(0, len(nodes), 8):
            run = nodes[start : start + 8]
            hashes = [h for h, _ in run]
            for i, (_, members) in enumerate(run):
                for m in members:
                    m["proof"] += "".join(hashes[:i] + hashes[i + 1 :])
                    m["folded"] = digest(*hashes[:i], m["folded"], *hashes[i + 1 :])
            above.append((digest(*hashes), [m for _, members in run for m in members]))
        nodes = above
    return nodes[0]


def plain(rows):
    items = []
    for r in rows:
        own = claimed = leaf(r, r[1])
        if r[0] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
            claimed = leaf(r, r[1].translate(LOWER))
        items.append((r[2], r[0], own, claimed))
    items.sort(key=lambda x: (x[0] is not None, (x[0] or "").encode(), x[1] is not None, x[1] or 0, x[2]))
    subroots = []
    for _, group in itertools.groupby(items, key=lambda x: x[0]):
        top = climb([(x[2], [{"id": x[1], "leaf": x[2], "folded": x[3], "proof": ""}]) for x in group])
        for m in top[1]:
            m["subroot"] = top[0]
        subroots.append(top)
    if not subroots:
        return []
    root, members = climb(subroots)
    out = [
        (m["id"], m["leaf"], m["subroot"], root, digest(m["proof"]), m["folded"], m["folded"] == root) for m in members
    ]
    return sorted(out, key=str)


CASES = {
    "awkward": awkward_documents(),
    "one": [(1, "Abc", "en", "s", 3)],
    "full run": [(i, "Abc", "en", "s", 3) for i in range(8)],
    "run of one": [(i, "Abc", "en", "s", 3) for i in range(9)],
    "lone leaves": [(i, "Abc", f"l{i}", "s", 3) for i in range(20)],
    "three levels": [(i, "Abc", f"l{i % 3}" if i % 50 else None, "s", 3) for i in range(300)],
    "repeated": [(5, "Same", "en", "s", 3)] * 70,
    "none": [],
}


@pytest.mark.parametrize("name", CASES)
def test_against_plain_python(spark, name):
    rows = CASES[name]
    got = merkle.checked_documents(documents(spark, rows))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows)


def test_against_sql_on_awkward_rows(spark, tmp_path):
    sf_dir = written(tmp_path, documents=documents(spark, awkward_documents()))
    assert against_sql(spark, "op13_merkle_manifest", sf_dir, ["documents"]) is None
    empty = written(tmp_path, documents=spark.createDataFrame([], DOCUMENTS))
    assert against_sql(spark, "op13_merkle_manifest", empty, ["documents"]) is None


def test_limits_of_recursion_are_put_back(spark):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    merkle.checked_documents(documents(spark, CASES["full run"])).collect()
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before
