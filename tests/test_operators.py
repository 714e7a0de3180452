"""Literal examples, brute-force checks under ties, replay, persistence, streaming and training."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from matchloom.functions import scalars as S
from matchloom.operators import asof, rating, tables
from matchloom.plans import features, ml
from matchloom.fixture import matches
from matchloom.sources import store
from matchloom.streaming import ingest

SF = "/root/testdata/sf0.001"


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


@pytest.mark.parametrize("score,key", [("6-4 6-2", "6462000000"), ("7-6 4-6 6-3", "7646630000"), ("6-4 3-6 6-2 7-5", "6436627500"), (None, "0000000000")])
def test_score_key(spark, score, key):
    assert one(spark, S.score_key(F.lit(score).cast("string"))) == key


@pytest.mark.parametrize("name,out", [("Jiri Lehecka", "JL"), ("Giovanni Mpetshi Perricard", "GMP"), ("Jean-Francois Smith", "JFS"), ("", "UNK"), (None, "UNK")])
def test_initials(spark, name, out):
    assert one(spark, S.initials(F.lit(name).cast("string"))) == out


@pytest.mark.parametrize("text,draw,out", [("2nd Round", 128, "R64"), ("1st Round", 64, "R64"), ("2nd Round", 32, "R16"), ("The Final", 32, "F"), ("odd", 32, None)])
def test_odds_round(spark, text, draw, out):
    assert one(spark, S.odds_round(F.lit(text), F.lit(draw))) == out


def test_texts(spark):
    assert one(spark, S.expand_score(F.lit("41 46 76(4)"))) == "4-1 4-6 7-6(4)"
    assert one(spark, S.match_id(F.lit(339), F.lit("2024-12-29").cast("date"), F.lit("F"), F.lit("Jiri Lehecka"), F.lit(103), F.lit("Reilly Opelka"), F.lit(187))) == "033925002JL03_RO87"
    assert one(spark, S.date_buffer_days(F.lit(32))) == 13 and one(spark, S.date_buffer_days(F.lit(128))) == 17
    want = datetime.date(2024, 1, 2)
    for t in ("2024-01-02", "20240102", "datetime.datetime(2024, 1, 2, 0, 0)", "45293", "2024-01-02 10:00:00"):
        assert one(spark, S.parse_date(F.lit(t))) == want
    assert one(spark, S.parse_date(F.lit("nonsense"))) is None
    assert [one(spark, S.valid_height(F.lit(x))) for x in ("1.85m", "185 cm", "90")] == [185, 185, None]
    s = one(spark, S.full_score(F.lit("6-4 7-6(5) 2-1 RET")))
    assert (s.sets, s.tiebreaks, s.ended_early, s.margin) == (2, 1, True, 3)


def test_last_k_under_ties(spark):
    rng = random.Random(4)
    ev = [(i, rng.randrange(4), rng.randrange(30), None if rng.random() < 0.25 else rng.random()) for i in range(500)]
    df = spark.createDataFrame(ev, "seq long, e int, kk long, v double").repartition(5)
    got = {r.seq: (r.x, r.g) for r in asof.last_k(df, ["e"], {"x": (F.col("v"), (3, 5), "avg"), "g": (F.col("v"), (1, 5), "gradient")}).withColumnsRenamed({"x_5": "x", "g_5": "g"}).collect()}
    for i, e, k, _ in ev:
        past = [x[3] for x in sorted((x for x in ev if x[1] == e and x[2] < k and x[3] is not None), key=lambda x: (x[2], x[0]))][-5:]
        want = sum(past) / len(past) if past else None
        slope = (past[-1] - past[0]) / (len(past) - 1) if len(past) > 1 else 0.0 if past else None
        for a, b in zip(got[i], (want, slope)):
            assert (a is None and b is None) or abs(a - b) < 1e-12


def test_no_leakage(spark):
    m = matches(spark, SF)
    cut = datetime.date(1997, 1, 1)
    whole = features.core(m).join(m.filter(F.col("tourney_date") < F.lit(cut)).select("seq"), "seq")
    part = features.core(m.filter(F.col("tourney_date") < F.lit(cut)))
    assert whole.exceptAll(part).count() == 0 == part.exceptAll(whole).count()


def test_elo(spark):
    m = matches(spark, SF)
    rows = asof.order_key(m).collect()
    state, want = {}, {}
    for r in sorted(rows, key=lambda r: (r.kk, r.seq)):
        k = 32 * rating.LEVEL.get(r.tourney_level, 0.75) * rating.ROUND.get(r.round, 0.8) * (1.0 if r.best_of == 5 else 0.9)
        for kind in ("general", r.surface):
            past = lambda p: next((v for kk, v in reversed(state.get((kind, p), [])) if kk < r.kk), 1500.0)
            a, b = past(r.player1_id), past(r.player2_id)
            for p, x, y, w in ((r.player1_id, a, b, r.RESULT), (r.player2_id, b, a, 1 - r.RESULT)):
                v = rating.updated(x, y, w, k)
                state.setdefault((kind, p), []).append((r.kk, v))
                want[kind, r.seq, p] = (x, v)
    got = {(r.rating_type, r.seq, r.player_id): (r.pre, r.post) for r in rating.rate(m).collect()}
    assert got.keys() == want.keys() and all(abs(got[k][i] - want[k][i]) < 1e-6 for k in got for i in (0, 1))
    old, new = m.filter("seq % 10 != 3"), m.filter("seq % 10 = 3")
    first = rating.rate(old)
    assert rating.needs_replay(new, first)
    again = {(r.rating_type, r.seq, r.player_id): r.post for r in rating.replay(old, new, first).collect()}
    assert again.keys() == got.keys() and all(abs(again[k] - got[k][1]) < 1e-6 for k in got)


def test_swap_and_conform(spark):
    df = spark.createDataFrame([(i, i, -i, 1) for i in range(100)], "id long, a long, b long, r int")
    out = tables.swap_sides(df, [("a", "b")], "r", F.col("id")).collect()
    assert all((x.a, x.b, x.r) in ((x.id, -x.id, 1), (-x.id, x.id, 0)) for x in out) and 20 < sum(x.r for x in out) < 80
    assert tables.conform(df, {"a": "string", "z": "int"}).first().asDict() == {"a": "0", "z": None}


def test_store_and_stream(spark, tmp_path):
    schema = "id long, v string, ts timestamp"
    spark.createDataFrame([(i % 10, f"{i}", datetime.datetime(2024, 1, 1, i % 24)) for i in range(30)], schema).write.parquet(f"{tmp_path}/in")
    for _ in range(2):
        q = ingest.ingest(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), f"{tmp_path}/snap", "id", f"{tmp_path}/cp")
        q.awaitTermination()
    assert store.load_snapshot(spark, f"{tmp_path}/snap").count() == 10
    for _ in range(6):
        v = store.save_snapshot(spark.range(3).toDF("id"), f"{tmp_path}/snap", keep=2)
    assert store._versions(spark, f"{tmp_path}/snap") == [v - 1, v]
    with pytest.raises(FileNotFoundError):
        store.load_snapshot(spark, f"{tmp_path}/none")
    e = spark.read.parquet(f"{tmp_path}/in")
    assert ingest.activity(e, "id", "ts", "1 day", "1 day").agg(F.sum("n")).first()[0] == 30
    doc = '{"setStats":{"set0":[{"name":"Aces","player1":"7","player2":"12/20 (60%)"}]}}'
    assert one(spark, store.side_stats(F.lit(doc), "Aces", 1)) == 7 and one(spark, store.side_stats(F.lit(doc), "Aces", 2)) == 12


def test_model(spark, tmp_path):
    df = spark.range(600).select((F.rand(1) - 0.5).alias("a"), F.rand(2).alias("b"), F.rand(3).alias("c")).withColumn("RESULT", (F.col("a") > 0).cast("int"))
    df.write.parquet(f"{tmp_path}/d")
    df = spark.read.parquet(f"{tmp_path}/d")
    model, chosen = ml.train(df, ["a", "b", "c"], percentile=60)
    assert chosen == ["a"] and ml.auc(ml.predict(model, df, chosen)) > 0.95
    model.write().overwrite().save(f"{tmp_path}/m")
    assert ml.accuracy(ml.predict(ml.PipelineModel.load(f"{tmp_path}/m"), df, chosen)).first()[0] > 0.9
