"""Scalar functions on columns: rounds, keys, identifiers, scores, odds rounds, names, validators, prices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Place of a round in the draw; the final is last.
ROUND_ORDER = {"ER": 256, "R128": 128, "R64": 64, "R32": 32, "R16": 16, "QF": 8, "SF": 4, "BR": 3, "F": 2}


def recode(value: Column, table: dict, default=None) -> Column:
    m = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.element_at(m, value), F.lit(default)) if default is not None else F.element_at(m, value)


def round_order(code: Column) -> Column:
    """Place of a round; a group round '9xx' is its number; unknown: 999."""
    return F.coalesce(F.when(code.rlike("^9[0-9]{2}$"), code.try_cast("int")), recode(code, ROUND_ORDER), F.lit(999))


def parse_date(text: Column) -> Column:
    """ISO dates and times, yyyyMMdd, datetime(...) representations, spreadsheet day numbers over 40000."""
    t = F.trim(text)
    rep = F.regexp_extract(t, r"datetime\((\d+), *(\d+), *(\d+)", 0)
    part = lambda i: F.regexp_extract(t, r"datetime\((\d+), *(\d+), *(\d+)", i)
    serial = t.try_cast("double")
    return F.coalesce(
        F.when(rep != "", F.try_to_date(F.concat_ws("-", part(1), F.lpad(part(2), 2, "0"), F.lpad(part(3), 2, "0")), "yyyy-MM-dd")),
        F.when(t.rlike(r"^\d{8}$"), F.try_to_date(t, "yyyyMMdd")),
        F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_date(F.substring(t, 1, 10), "yyyy-MM-dd")),
        F.when(t.rlike(r"^\d{5}(\.\d+)?$") & (serial > 40000), F.date_add(F.lit("1899-12-30").cast("date"), F.floor(serial).cast("int"))),
    )


def initials(name: Column) -> Column:
    """First letters of the parts between spaces and hyphens; UNK without any."""
    parts = F.filter(F.split(F.trim(name), r"[\s-]+"), lambda x: x != "")
    out = F.upper(F.array_join(F.transform(parts, lambda x: F.substring(x, 1, 1)), ""))
    return F.when(F.coalesce(out, F.lit("")) == "", "UNK").otherwise(out)


def match_id(tourney: Column, date: Column, round_code: Column, name1: Column, id1: Column, name2: Column, id2: Column) -> Column:
    """tourney(4) year(2, from 25 December the next) round(3) initials and id modulo 100 of both, joined by _."""
    year = F.year(date) + F.when((F.month(date) == 12) & (F.dayofmonth(date) >= 25), 1).otherwise(0)
    code = F.when(round_code.rlike("^9[0-9]{2}$"), round_code).otherwise(F.format_string("%03d", round_order(round_code)))
    side = lambda n, i: F.concat(initials(n), F.format_string("%02d", F.pmod(F.coalesce(i, F.lit(0)), F.lit(100)).cast("int")))
    return F.concat(F.format_string("%04d", tourney.cast("int")), F.format_string("%02d", F.pmod(year, F.lit(100)).cast("int")), code, side(name1, id1), F.lit("_"), side(name2, id2))


def match_id_parts(mid: Column) -> Column:
    return F.struct(F.substring(mid, 1, 4).alias("tourney"), F.substring(mid, 5, 2).alias("year"), F.substring(mid, 7, 3).alias("round"), F.substring(mid, 10, 99).alias("players"))


_SET = r"(\d+)-(\d+)(?:\(\d+\))?"


def set_games(score: Column, side: int, n: int = 5) -> list[Column]:
    """Games of a side (1, 2) in each of n sets; a set that wasn't played: 0."""
    found = F.regexp_extract_all(F.coalesce(score, F.lit("")), F.lit(_SET), F.lit(side))
    return [F.coalesce(F.get(found, i).try_cast("int"), F.lit(0)) for i in range(n)]


def score_key(score: Column) -> Column:
    """The games of five sets, one after the other: ten characters, and more where a set has ten games or more (70-68: 7068)."""
    a, b = set_games(score, 1), set_games(score, 2)
    return F.concat(*[F.concat(x.cast("string"), y.cast("string")) for x, y in zip(a, b)])


def full_score(score: Column) -> Column:
    """Sets, tie-breaks, whether it ended early; a last set that wasn't finished is left out then."""
    s = F.coalesce(score, F.lit(""))
    early = F.upper(s).rlike(r"RET|DEF|W/O")
    a = F.transform(F.regexp_extract_all(s, F.lit(_SET), F.lit(1)), lambda x: x.cast("int"))
    b = F.transform(F.regexp_extract_all(s, F.lit(_SET), F.lit(2)), lambda x: x.cast("int"))
    sets = F.arrays_zip(a.alias("a"), b.alias("b"))
    n = F.size(a)
    last_open = early & (n > 0) & (F.element_at(a, -1) < 6) & (F.element_at(b, -1) < 6)
    kept = F.when(last_open, F.slice(sets, 1, F.greatest(n - 1, F.lit(0)))).otherwise(sets)
    return F.struct(F.size(kept).alias("sets"), F.size(F.regexp_extract_all(s, F.lit(r"\((\d+)\)"), F.lit(1))).alias("tiebreaks"), early.alias("ended_early"), F.aggregate(kept, F.lit(0), lambda x, y: x + y["a"] - y["b"]).alias("margin"))


def expand_score(compact: Column) -> Column:
    """'41 46 76(4)' becomes '4-1 4-6 7-6(4)'."""
    return F.regexp_replace(compact, r"(?<![\d(])(\d)(\d)(?!\d)", r"$1-$2")


def odds_round(text: Column, draw: Column) -> Column:
    """A bookmaker's round name by draw size."""
    named = recode(text, {"The Final": "F", "Semifinals": "SF", "Quarterfinals": "QF", "Round Robin": "RR"})
    nth = F.regexp_extract(text, r"^(\d)", 1).try_cast("int")
    left = F.floor(draw / F.pow(F.lit(2.0), nth - 1))
    sized = F.when(left > 64, "R128").when(left > 32, "R64").when(left > 16, "R32").when(left > 8, "R16").when(left > 4, "QF").when(left > 2, "SF").otherwise("F")
    return F.coalesce(named, F.when(nth.isNotNull(), sized))


def date_buffer_days(draw: Column) -> Column:
    """Days after its begin until which an event of that draw can be priced: 3 + 2 log2(draw)."""
    return F.lit(3.0) + F.log2(F.greatest(draw, F.lit(1)).cast("double")) * 2


def age(born: Column, on: Column) -> Column:
    return F.round(F.datediff(on, born) / 365.25, 1)


def tokens(name: Column, stop: tuple[str, ...] = ("the", "of", "open", "cup")) -> Column:
    clean = F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), r"[^a-z0-9\s]", " ")
    return F.array_distinct(F.filter(F.split(F.trim(clean), r"\s+"), lambda x: (F.length(x) > 1) & ~x.isin(*stop)))


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(0.0)


def is_empty(value: Column) -> Column:
    return value.isNull() | F.lower(F.trim(value)).isin("", "0", "nan", "none", "null", "unknown", "n/a", "na")


def valid_height(text: Column) -> Column:
    """Centimetres from '1.85', '185', '185cm', '1.85m'; outside 150-220: null."""
    n = F.regexp_extract(F.lower(text), r"(\d+(?:\.\d+)?)", 1).try_cast("double")
    cm = F.round(F.when(n < 3, n * 100).otherwise(n)).cast("int")
    return F.when(cm.between(150, 220), cm)


def valid_hand(text: Column) -> Column:
    words = {"l": "L", "left": "L", "left-handed": "L", "lefthanded": "L", "r": "R", "right": "R", "right-handed": "R", "righthanded": "R", "u": "U", "unknown": "U", "ambidextrous": "U", "both": "U"}
    return recode(F.lower(F.trim(text)), words)


def valid_dob(text: Column, today: Column | None = None) -> Column:
    """A date of birth in ISO, yyyy/MM/dd, yyyyMMdd, month or day first with / or -; from 1940 to 16 years ago, else null.

    Of a date that fits with the month or the day first, the month is first.
    """
    t = F.trim(text)
    tried = [("^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$", "yyyy-M-d"), ("^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}$", "yyyy/M/d"), ("^[0-9]{8}$", "yyyyMMdd")]
    tried += [(f"^[0-9]{{1,2}}{x}[0-9]{{1,2}}{x}[0-9]{{4}}$", f) for x in "/-" for f in (f"M{x}d{x}yyyy", f"d{x}M{x}yyyy")]
    found = F.coalesce(*[F.when(t.rlike(p), F.try_to_date(t, f)) for p, f in tried])
    last = F.add_months(F.current_date() if today is None else today, -16 * 12)
    return F.when(found.between(F.lit("1940-01-01").cast("date"), last), found)


#: Codes of the sources of matches.
SOURCES = {0: "main_dataset", 1: "infosys_api", 2: "tennis_api"}


def source_name(code: Column) -> Column:
    return F.coalesce(recode(code.cast("int"), SOURCES), F.concat(F.lit("unknown_"), code.cast("string")))


def source_code(name: Column) -> Column:
    return recode(F.lower(F.trim(name)), {v: k for k, v in SOURCES.items()})


def calendar_parts(text: Column) -> tuple[Column, Column]:
    """(from, to) of a calendar's 'a - b'; the second null without it."""
    parts = F.split(text, " - ")
    return F.trim(F.get(parts, F.lit(0))), F.trim(F.get(parts, F.lit(1)))


def last_path_part(url: Column) -> Column:
    """The last part of an address's path that isn't empty, such as a match's id."""
    return F.element_at(F.filter(F.split(F.regexp_extract(url, r"^([^?#]*)", 1), "/"), lambda x: x != ""), -1)


def best_of(*odds: Column) -> Column:
    """The greatest of several prices; nulls don't count."""
    return F.greatest(*odds) if len(odds) > 1 else odds[0]


#: First and last identifier by level; other levels take that of C.
LEVEL_RANGES = {"G": (5000, 5999), "O": (4800, 4999), "M": (4500, 4799), "F": (4500, 4999), "D": (4000, 4499), "A": (2000, 3999), "C": (1000, 1999), "S": (1000, 1999)}


def level_range(level: Column) -> tuple[Column, Column]:
    """First and last identifier of a level."""
    bound = lambda i: recode(F.upper(level), {k: v[i] for k, v in LEVEL_RANGES.items()}, LEVEL_RANGES["C"][i])
    return bound(0), bound(1)


def id_fits_level(source_id: Column, level: Column) -> Column:
    """Four digits within the level's range."""
    low, high = level_range(level)
    return F.coalesce(source_id.rlike("^[0-9]{4}$") & source_id.try_cast("int").between(low, high), F.lit(False))


def id_problem(source_id: Column) -> Column:
    """What is wrong with an event's source id: the first of these, else null."""
    return F.when(source_id.contains("-"), "hyphen").when(source_id.rlike("[^A-Za-z0-9]"), "special").when(F.length(source_id) > 5, "long").when(~source_id.rlike("^[0-9]+$"), "letters")


def clean_event_id(source_id: Column, name: Column) -> Column:
    """Team cups by the word after their name, the games' one id, else what follows the year's hyphen with letters as 0."""
    word = F.upper(F.regexp_extract(name, r"(?i)Davis Cup\s+(\w+)", 1))
    cup = F.when(word == "FINALS", "430").when(word.isin("G1", "WG1", "WG"), "431").when(word.isin("WG2", "G2"), "432").when(word == "QLS", "433")
    plain = F.when(source_id.contains("-"), F.get(F.split(source_id, "-"), 1)).otherwise(source_id)
    return F.when(F.lower(name).contains("olympic"), "4800").otherwise(F.coalesce(cup, F.regexp_replace(plain, "[a-zA-Z]", "0")))


def title(name: Column) -> Column:
    """Words with a capital; the tours' and countries' short names in capitals."""
    keep = ("ATP", "WTA", "ITF", "US", "UK")
    return F.array_join(F.transform(F.filter(F.split(F.trim(name), r"\s+"), lambda x: x != ""), lambda w: F.when(F.upper(w).isin(*keep), F.upper(w)).otherwise(F.initcap(w))), " ")


def _once(value: Column, body) -> Column:
    """body(value) with value computed once, though body names it many times."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _name_parts(name: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(F.lower(name), r"[.\-]", " "), r"\s+"), lambda x: x != "")


def priced_name(name: Column) -> Column:
    """(last, initials) of a bookmaker's 'Van Der Meer J.'; one word is all last name."""
    parts = F.filter(F.split(F.trim(F.coalesce(name, F.lit(""))), r"\s+"), lambda x: x != "")
    n = F.size(parts)
    initials_ = F.when(n > 1, F.regexp_replace(F.element_at(parts, -1), r"\.", "")).otherwise("")
    return F.struct(F.when(n > 1, F.array_join(F.slice(parts, 1, F.greatest(n - 1, F.lit(1))), " ")).otherwise(F.array_join(parts, " ")).alias("last"), initials_.alias("initials"))


def tie_full(full: Column) -> Column:
    """(name, first): the last word and the initial of a full name, one side of tied()."""
    return _once(_name_parts(full), lambda a: F.struct(F.coalesce(F.get(a, F.size(a) - 1), F.lit("")).alias("name"), F.substring(F.get(a, F.lit(0)), 1, 1).alias("first")))


def tie_priced(priced: Column) -> Column:
    """(name, first): the first word and the second's initial of a bookmaker's name, the other side of tied()."""
    return _once(_name_parts(priced), lambda b: F.struct(F.coalesce(F.get(b, F.lit(0)), F.lit("")).alias("name"), F.substring(F.get(b, F.lit(1)), 1, 1).alias("first")))


def tied(a: Column, b: Column) -> Column:
    x, y = a["name"], b["name"]
    last = F.when(x == y, 2.0).when(x.contains(y) | y.contains(x), 1.5).otherwise(0.0)
    return F.when((x != "") & (y != ""), last + F.when(a["first"] == b["first"], 1.0).otherwise(0.0)).otherwise(0.0)


def tie_break(full: Column, priced: Column) -> Column:
    """2 for the last name, 1.5 for a part of it, and 1 for the initial; 0 with a null."""
    return tied(tie_full(full), tie_priced(priced))


def oriented_prices(first_won: Column, maximum: tuple[Column, Column], sharp: tuple[Column, Column], soft: tuple[Column, Column]) -> dict[str, Column]:
    """Prices of (winner, loser) as those of players 1 and 2, with the source: sharp, else soft, else the maximum only."""
    side = lambda w, l: F.when(first_won, w).otherwise(l)
    price = [F.coalesce(a, b) for a, b in zip(sharp, soft)]
    both = lambda p: p[0].isNotNull() & p[1].isNotNull()
    return {"p1_max_odds": side(*maximum), "p2_max_odds": side(*maximum[::-1]), "p1_odds": side(*price), "p2_odds": side(*price[::-1]), "odds_source": F.when(both(sharp), "pinnacle").when(both(soft), "bet365").otherwise("max_only")}


def draw_size(text: Column) -> Column:
    """The singles draw in 'SGL 32 | DBL 16'."""
    return F.regexp_extract(text, r"SGL\s*(\d+)", 1).try_cast("int")


def implied_probability(odds: Column, other: Column) -> Column:
    return (1 / odds) / (1 / odds + 1 / other)


def expected_value(probability: Column, odds: Column) -> Column:
    return odds * probability - 1


def kelly(probability: Column, odds: Column, bankroll: Column, fraction: float = 0.25) -> Column:
    b = odds - 1
    return F.greatest(F.when(b > 0, (b * probability - (1 - probability)) / b).otherwise(0.0), F.lit(0.0)) * bankroll * fraction
