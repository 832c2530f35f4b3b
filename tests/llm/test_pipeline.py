"""The pipeline's stages against plain Python, on documents whose fate is known."""

import random

import corpus_pipeline as C
import public_tokenizers as P
from helpers import DOCUMENTS, awkward_documents, prose, written
from test_minhash import brute_force
from test_operators import RANKS

from mirrorflow.llm.bpe import encoding


def test_stages_on_awkward_documents(spark, tmp_path):
    rnd = random.Random(2)
    good = [(1000 + i, prose(i, 90, 3000), "en", "s1" if i % 3 else "s2", 9) for i in range(80)]
    near = good[5][1].split(" ")
    near[50] = "changed"
    planted = [
        (2000, good[3][1], "en", "s2", 9),  # an exact copy
        (2001, " ".join(near), "en", "s2", 9),  # a near copy
        (2002, prose(900, 80, 3000) + " mail me: x@mail.example.com +1 (319) 555-5132", "en", "s1", 9),
        (2003, "too short", "en", "s1", 9),
        (2004, "again and again " * 40, "en", "s1", 9),
        (2005, " ".join(f"{w}%%%" for w in prose(901, 80, 3000).split()), "en", "s1", 9),
    ]
    rows = good + planted + awkward_documents()
    rnd.shuffle(rows)
    sf_dir = written(tmp_path, documents=spark.createDataFrame(rows, DOCUMENTS))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = {}
    for name, stage in C.STAGES:
        out = stage(spark, docs, sf_dir)
        if name != "token_ids":
            assert out.columns == docs.columns
        path = str(tmp_path / name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = docs.collect()

    def ids(name):
        return [r.doc_id for r in seen[name]]

    kept = set(ids("quality_rules"))
    assert {r[0] for r in good} | {2000, 2001, 2002} <= kept and not kept & {2003, 2004, 2005}
    # one document of each group stays
    want = brute_force([(10**6 if r.doc_id is None else r.doc_id, r.text) for r in seen["quality_rules"]], 80)
    once = {r[2] for r in want}
    assert sorted(10**6 if i is None else i for i in ids("near_duplicates")) == sorted(once)
    assert not {2000, 2001} & set(ids("near_duplicates"))
    text = {r.doc_id: r for r in seen["personal_data"]}
    assert sorted(map(str, text)) == sorted(map(str, set(ids("near_duplicates"))))
    assert text[2002].text.endswith("mail me: <EMAIL> <PHONE>")
    assert all(r.n_chars == len(r.text) for r in seen["personal_data"])
    assert all(text[r[0]].text == r[1] for r in good if r[0] in text)
    mixed = ids("mix_sources")
    assert set(mixed) == set(text) and max(mixed.count(i) for i in set(mixed)) <= 2
    whole = encoding(RANKS, P.PATTERN)
    assert sorted(map(str, ids("token_ids"))) == sorted(map(str, mixed))
    for r in seen["token_ids"]:
        assert r.ids == whole.encode_ordinary(text[r.doc_id].text) and r.n_tokens == len(r.ids)


def test_run_and_empty_table(spark, tmp_path):
    out = C.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "source", "n_tokens", "ids"] and out.count() > 100
    empty = written(tmp_path, documents=spark.createDataFrame([], DOCUMENTS))
    assert C.run(spark, empty).count() == 0
