"""Literal cases of small functions, and of operators whose results follow from their inputs."""

import datetime

from pyspark.sql import functions as F

from matchloom.fixture import matches
from matchloom.functions import scalars as S
from matchloom.functions import similarity
from matchloom.operators import asof, backtest, odds, rating, resolve, tables
from matchloom.plans import features, ml

SF = "/root/testdata/sf0.001"


def values(spark, make, cases):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, x string")
    return [r.y for r in df.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()]


def test_names(spark):
    assert values(spark, S.title, ["atp finals", " wta  open", "us open", None]) == ["ATP Finals", "WTA Open", "US Open", None]
    assert values(spark, similarity.valid_player_name, ["Jo-W. O'Neil", "x", "12", "", None, "A1"]) == [True, False, False, False, False, False]
    assert values(spark, similarity.name_variations, ["Ann Mary Bell", "Cher"]) == [["a-bell", "ann-mary-bell", "bell-mary-ann"], ["cher"]]
    assert values(spark, lambda c: similarity.similarity_category(c.cast("double")), ["0.8", "0.79", "0.6", "0.1"]) == ["high", "medium", "medium", "low"]
    assert values(spark, S.source_code, ["Infosys_API", "none", None]) == [1, None, None]
    assert values(spark, S.is_empty, [None, " NaN ", "0", "x"]) == [True, True, True, False]
    assert values(spark, S.valid_dob, ["1981-8-8", "1981/08/08", "19810808", "08/09/1981", "25/12/1981", "31-12-1981", "1930-01-01", "0", None]) == [datetime.date(1981, 8, 8)] * 3 + [datetime.date(1981, 8, 9), datetime.date(1981, 12, 25), datetime.date(1981, 12, 31), None, None, None]


def test_ratings_at_a_key(spark):
    m = asof.order_key(matches(spark, SF))
    r = rating.rate(m.drop("kk")).cache()
    key = sorted(x.kk for x in m.select("kk").collect())[700]
    want = {}
    for x in r.filter(F.col("kk") < key).orderBy("kk", "seq").collect():
        want[x.rating_type, x.player_id] = x.post
    assert {(x.rating_type, x.player_id): x.elo for x in rating.as_of(r, key).collect()} == want
    assert rating.needs_replay(m.filter(F.col("kk") == key).drop("kk"), r) and not rating.needs_replay(m.limit(0).drop("kk"), r)


def test_a_rating_by_hand(spark):
    """Grand slam final over five sets, equal players: the factor of 1500 is 10, so K is 320 and each half of it moves."""
    row = [(1, datetime.date(2024, 1, 1), 1, 2, "G", "F", 5, "Hard", 1, 2, 1)]
    m = spark.createDataFrame(row, "seq long, tourney_date date, tourney_id int, round_order int, tourney_level string, round string, best_of int, surface string, player1_id int, player2_id int, RESULT int")
    got = {(r.rating_type, r.player_id): (r.pre, r.post) for r in rating.rate(m).collect()}
    assert got == {(t, p): (1500.0, 1500.0 + d) for t in ("general", "Hard") for p, d in ((1, 160.0), (2, -160.0))}


def test_archived_order(spark):
    m = spark.createDataFrame([(1, "F"), (2, "RR"), (3, "SF"), (4, "?"), (5, "R128")], "seq long, round string").withColumns({"tourney_date": F.lit("2024-01-01").cast("date"), "tourney_id": F.lit(1)})
    assert [r.seq for r in asof.order_key(rating.archived_order(m)).orderBy("kk").collect()] == [2, 5, 3, 1, 4]


def test_splits_and_swaps(spark):
    df = spark.range(4000)
    train, test = backtest.random_split(df, F.col("id"))
    assert train.count() + test.count() == 4000 and train.intersect(test).count() == 0 and 480 < test.count() < 720
    assert tables.rename_sides(spark.createDataFrame([(1, 2, 3)], "winner_id int, l_ace int, x int")).columns == ["player1_id", "p2_ace", "x"]


def test_reports(spark):
    out = spark.createDataFrame([("linked",), ("linked",), ("created",), ("linked",)], "action string")
    assert {r.action: (r.n, r.percent) for r in resolve.quality_report(out).collect()} == {"linked": (3, 75.0), "created": (1, 25.0)}
    linked = spark.createDataFrame([("enriched", "auto_rank", None), ("failed", None, "no_score_matches")], "status string, method string, reason string")
    assert {r.status: r.percent for r in odds.method_counts(linked).collect()} == {"enriched": 50.0, "failed": 50.0}


def test_one_match_that_may_be_played(spark):
    m = matches(spark, SF)
    last = m.orderBy(F.desc("tourney_date"), F.desc("tourney_id"), "round_order", F.desc("seq")).limit(1).collect()[0]
    history = m.filter(F.col("seq") != last.seq)
    one = spark.createDataFrame([last], m.schema)
    want = features.features(m).filter(F.col("seq") == last.seq).first().asDict()
    got = features.hypothetical(history, one).first().asDict()
    assert got.keys() == want.keys() and all(got[k] == want[k] or abs(got[k] - want[k]) < 1e-9 for k in got)


def test_tuning(spark):
    df = spark.range(400).select((F.rand(1) - 0.5).alias("a"), F.rand(2).alias("b")).withColumn("RESULT", (F.col("a") > 0).cast("double"))
    best = ml.tune(df, ["a", "b"], depths=(1, 2), rounds=(2,), folds=2)
    assert len(best.avgMetrics) == 2 and max(best.avgMetrics) > 0.9
