"""Elo ratings, general and per surface: the one recurrence that no window expresses.

Each match becomes an event of the general rating and one of its surface. Rating types are independent, so each is a
sequential fold of its own over sorted, streamed rows; state is one small entry per player, however long the history.
Ties: matches of a player with equal keys read the rating from before the tie, and the later to arrive is the one that
later keys see.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .asof import order_key

#: Fixed values of the K factor.
LEVEL = {"G": 1.0, "O": 0.9, "F": 0.9, "M": 0.85, "A": 0.75}
ROUND = {"F": 1.0, "BR": 0.95, "SF": 0.9, "QF": 0.85, "RR": 0.85, "R16": 0.8, "R32": 0.8, "R64": 0.75, "R128": 0.75, "ER": 0.75}
START = 1500.0


def k_factor(level: Column, round_: Column, best_of: Column) -> Column:
    """Without the rating's own part, which the fold applies."""
    table = lambda c, t, d: F.coalesce(F.element_at(F.create_map(*[F.lit(x) for p in t.items() for x in p]), c), F.lit(d))
    return F.lit(32.0) * table(level, LEVEL, 0.75) * table(round_, ROUND, 0.8) * F.when(best_of == 5, 1.0).otherwise(0.9)


def updated(rating: float, opponent: float, won: float, k: float) -> float:
    own = 1 + 18 / (1 + 2 ** ((rating - 1500) / 63))
    return rating + k * own * (won - 1 / (1 + 10 ** ((opponent - rating) / 400)))


def rate(matches: DataFrame, seed: DataFrame | None = None) -> DataFrame:
    """(rating_type, seq, kk, player_id, pre, post): a row per player and rating of each match.

    seed: such rows of earlier matches; their last ratings start the fold, which replays only what is new.
    """
    side = lambda p: F.struct(F.col(f"player{p}_id").alias("player_id"), F.col(f"pre{p}").alias("pre"), F.col(f"post{p}").alias("post"))
    return by_match(matches, seed).select("rating_type", "seq", "kk", F.inline(F.array(side(1), side(2))))


def by_match(matches: DataFrame, seed: DataFrame | None = None, kinds: tuple[str, ...] = ("general", "surface")) -> DataFrame:
    """(rating_type, seq, kk, player1_id, player2_id, pre1, post1, pre2, post2): a row per rating of each match."""
    m = order_key(matches).withColumn("k", k_factor(F.col("tourney_level"), F.col("round"), F.col("best_of")))
    e = m.select(F.explode(F.array(*[F.lit(k) if k == "general" else F.col(k) for k in kinds])).alias("rating_type"), "seq", "kk", "player1_id", "player2_id", F.col("RESULT").cast("double").alias("won"), "k")
    e = e.withColumn("pre", F.lit(None).cast("double"))
    if seed is not None:
        last = seed.groupBy("rating_type", "player_id").agg(F.max_by("post", F.struct("kk", "seq")).alias("pre"))
        e = e.unionByName(last.select("rating_type", F.lit(-1).cast("long").alias("seq"), F.lit(-1).cast("long").alias("kk"), F.col("player_id").alias("player1_id"), F.lit(None).cast("int").alias("player2_id"), F.lit(0.0).alias("won"), F.lit(0.0).alias("k"), "pre"))
    e = e.repartition("rating_type").sortWithinPartitions("rating_type", "kk", "seq")
    names = ["rating_type", "seq", "kk", "player1_id", "player2_id", "pre1", "post1", "pre2", "post2"]

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kind, state = None, {}

        def read(player: int, kk: int) -> list:
            s = state.setdefault(player, [kk, START, START])
            if s[0] != kk:
                s[0], s[1] = kk, s[2]
            return s

        for b in batches:
            out = []
            for t, seq, kk, p1, p2, won, k, pre in zip(*(b[c].tolist() for c in ("rating_type", "seq", "kk", "player1_id", "player2_id", "won", "k", "pre"))):
                if t != kind:
                    kind, state = t, {}
                if kk < 0:
                    state[p1] = [kk, pre, pre]
                    continue
                a, c = read(p1, kk), read(int(p2), kk)
                x, y = a[1], c[1]
                a[2], c[2] = updated(x, y, won, k), updated(y, x, 1 - won, k)
                out.append((t, seq, kk, p1, int(p2), x, a[2], y, c[2]))
            yield pd.DataFrame(out, columns=names)

    return e.mapInPandas(fold, "rating_type string, seq long, kk long, player1_id int, player2_id int, pre1 double, post1 double, pre2 double, post2 double")


def needs_replay(new: DataFrame, ratings: DataFrame) -> bool:
    """Whether a new match comes before one already rated."""
    first, last = order_key(new).agg(F.min("kk")).first()[0], ratings.agg(F.max("kk")).first()[0]
    return first is not None and last is not None and first <= last


def replay(history: DataFrame, new: DataFrame, ratings: DataFrame) -> DataFrame:
    """Ratings of history and new matches; of earlier ratings only those before the first new key stay.

    Give ratings as a stored table (a snapshot): they are read for what stays, and again for the state to go on from.
    """
    first = order_key(new).agg(F.min("kk")).first()[0]
    if first is None:
        return ratings
    kept = ratings.filter(F.col("kk") < first)
    every = order_key(history.unionByName(new)).filter(F.col("kk") >= first).drop("kk")
    return kept.unionByName(rate(every, kept))


def current(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("rating_type", "player_id").agg(F.max_by("post", F.struct("kk", "seq")).alias("elo"))


def as_of(ratings: DataFrame, kk: int) -> DataFrame:
    """Each player's ratings strictly before a key."""
    return current(ratings.filter(F.col("kk") < kk))


#: Rounds in the archived order, where round robin comes first and what is unknown last.
ARCHIVED = {"RR": 0, "ER": 0, "R128": 1, "R64": 2, "R32": 3, "R16": 4, "QF": 5, "SF": 6, "BR": 7, "F": 8}


def archived_order(matches: DataFrame) -> DataFrame:
    """matches whose round_order makes order_key() sort in the archived way: by date, tournament, then ARCHIVED, unknown last."""
    table = F.create_map(*[F.lit(x) for p in ARCHIVED.items() for x in p])
    return matches.withColumn("round_order", 2000 - F.coalesce(F.element_at(table, F.col("round")), F.lit(99)))
