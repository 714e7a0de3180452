"""An original with independently edited copies: each is alike to the original, hardly any two to one another."""

import random

import corpus_pipeline as P
from matchloom.llm import minhash


def star(copies, hub, seed):
    rng = random.Random(seed)
    original = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    out = []
    for i in range(copies + 1):
        t = list(original)
        for at in rng.sample(range(10, 190, 5), 4) if i != hub else ():
            t[at] = f"e{i}x{at}"
        out.append((i, " ".join(t)))
    return out


def test_every_copy_is_linked(spark):
    df = spark.createDataFrame(star(150, 83, 3), "doc_id long, text string").repartition(3)
    assert {r.class_id for r in minhash.classes(df).collect()} == {0}


def test_pipeline_keeps_one_of_a_star(spark, tmp_path):
    rows = [(i, t, "en", "a", len(t)) for i, t in star(100, 61, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    assert [r.doc_id for r in P.one_of_each_class(spark, docs, str(tmp_path)).collect()] == [0]
