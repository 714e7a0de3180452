"""Sources and sinks: typed scans, versioned snapshots with retention, run logs, exports, and the store of derived tables."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import parse_date
from ..operators.tables import apply_filters, upsert


def load(spark: SparkSession, source: DataFrame | str, schema: str | None = None, **filters) -> DataFrame:
    """A DataFrame, a table name, or a path whose ending tells its format; filters as apply_filters() takes them."""
    return apply_filters(_loaded(spark, source, schema), **filters)


def _loaded(spark: SparkSession, source: DataFrame | str, schema: str | None) -> DataFrame:
    if isinstance(source, DataFrame):
        return source
    kind = source.rstrip("/").rsplit(".", 1)[-1].lower() if "/" in source else "table"
    if kind == "table":
        return spark.table(source)
    reader = spark.read.schema(schema) if schema else spark.read
    if kind == "csv":
        return reader.option("header", True).csv(source)
    return reader.json(source) if kind in ("json", "jsonl") else reader.parquet(source)


def typed(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Text columns as these types, where a cell allows it, else null; dates in any of the forms that parse_date() knows."""
    return df.withColumns({c: parse_date(F.col(c).cast("string")) if t == "date" else F.col(c).try_cast(t) for c, t in columns.items() if c in df.columns})


def load_years(spark: SparkSession, template: str, years: range, schema: str, dates: tuple[str, ...] = ()) -> DataFrame:
    """One scan of yearly CSV files that exist, with the year as a column; dates: text columns to be read as dates."""
    return typed(_years(spark, template, years, schema), {c: "date" for c in dates})


def _years(spark: SparkSession, template: str, years: range, schema: str) -> DataFrame:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    there = []
    for y in years:
        p = jvm.org.apache.hadoop.fs.Path(template.format(year=y))
        if p.getFileSystem(conf).exists(p):
            there.append(template.format(year=y))
    if not there:
        return spark.createDataFrame([], schema + ", year int")
    year = F.regexp_extract(F.col("_metadata.file_path"), r"(\d{4})\D*$", 1).cast("int")
    return spark.read.schema(schema).option("header", True).csv(there).withColumn("year", year)


_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def sheet_rows(content: bytes) -> Iterator[dict[str, str]]:
    """The first sheet of a spreadsheet file (.xlsx) as rows by the names of its first row; empty cells stay out."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            for _, e in ElementTree.iterparse(z.open("xl/sharedStrings.xml")):
                if e.tag == _MAIN + "si":
                    shared.append("".join(t.text or "" for t in e.iter(_MAIN + "t")))
                    e.clear()
        sheet = min((n for n in z.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.findall(r"\d+", n)[0]))
        names: dict[str, str] | None = None
        for _, e in ElementTree.iterparse(z.open(sheet)):
            if e.tag != _MAIN + "row":
                continue
            cells = {}
            for c in e.iter(_MAIN + "c"):
                place = re.match("[A-Z]+", c.get("r", ""))
                v = c.find(_MAIN + "v")
                text = "".join(t.text or "" for t in c.iter(_MAIN + "t")) if c.get("t") == "inlineStr" else None if v is None else shared[int(v.text)] if c.get("t") == "s" else v.text
                if place and text not in (None, ""):
                    cells[place[0]] = text
            e.clear()
            if names is None:
                names = cells
            elif cells:
                yield {names[k]: x for k, x in cells.items() if k in names}


def load_sheets(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """Spreadsheet files (.xlsx) of a path or pattern, a task per file: these columns, typed, absent ones null, and the year of
    the file's name. Older .xls files are to be converted first."""
    names = list(columns)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for file, content in zip(b["path"], b["content"]):
                year = re.findall(r"(\d{4})\D*$", file)
                rows = [[r.get(n) for n in names] + [int(year[0]) if year else None] for r in sheet_rows(content)]
                yield pd.DataFrame(rows, columns=[*names, "year"]).astype(object)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    text = files.mapInPandas(read, ", ".join([*[f"`{n}` string" for n in names], "year int"]))
    return typed(text, columns)


def _versions(spark: SparkSession, root: str) -> list[int]:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit() and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{root}/{n}/_SUCCESS")))


def save_snapshot(df: DataFrame, root: str, keep: int = 5) -> int:
    """Writes the next version and removes all but the newest keep; a version counts once it is complete."""
    spark = df.sparkSession
    v = max(_versions(spark, root), default=0) + 1
    df.write.parquet(f"{root}/v={v}")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for old in _versions(spark, root)[:-keep]:
        p = jvm.org.apache.hadoop.fs.Path(f"{root}/v={old}")
        p.getFileSystem(conf).delete(p, True)
    return v


def load_snapshot(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    v = version if version is not None else max(_versions(spark, root), default=None)
    if v is None:
        raise FileNotFoundError(f"no snapshot under {root}")
    return spark.read.parquet(f"{root}/v={v}")


def log_run(spark: SparkSession, path: str, **facts) -> None:
    spark.createDataFrame([{k: str(v) for k, v in facts.items()}]).withColumn("at", F.current_timestamp().cast("string")).write.mode("append").json(path)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("quoteAll", True).csv(path)


class Store:
    """Derived tables under one root, each in complete versions: player events, ratings, processed matches, registries.

    A write makes a new version, so that an older one is its own backup until keep newer ones are there.
    """

    def __init__(self, spark: SparkSession, root: str, keep: int = 5):
        self.spark, self.root, self.keep = spark, root.rstrip("/"), keep

    def versions(self, name: str) -> list[int]:
        return _versions(self.spark, f"{self.root}/{name}")

    def read(self, name: str, version: int | None = None) -> DataFrame | None:
        """The newest or a given version; None without any."""
        return load_snapshot(self.spark, f"{self.root}/{name}", version) if self.versions(name) else None

    def write(self, name: str, df: DataFrame) -> int:
        return save_snapshot(df, f"{self.root}/{name}", self.keep)

    def append_new(self, name: str, df: DataFrame, key: str, replace: bool = False) -> tuple[int, int]:
        """Rows whose key is new enter (replace: others take their place): the new version and how many keys were new."""
        now = self.read(name)
        if now is None:
            v = self.write(name, df.dropDuplicates([key]))
            return v, self.read(name).count()
        before = now.count()
        v = self.write(name, upsert(now, df, key, replace))
        return v, self.read(name).count() - before

    def append_events(self, name: str, events: DataFrame, match: str = "seq") -> int:
        """Events of matches that the table lacks enter, all of a match or none; events of known matches are left out."""
        now = self.read(name)
        fresh = events if now is None else now.unionByName(events.join(now.select(match).distinct(), match, "left_anti"), allowMissingColumns=True)
        return self.write(name, fresh)

    def restore(self, name: str, version: int) -> int:
        """An older version becomes the newest."""
        return self.write(name, load_snapshot(self.spark, f"{self.root}/{name}", version))

    def export_json(self, name: str, path: str) -> None:
        self.read(name).write.mode("overwrite").json(path)

    def import_json(self, name: str, path: str, schema) -> int:
        return self.write(name, self.spark.read.schema(schema).json(path))

    def clear(self, name: str, confirm: bool = False) -> int | None:
        """An empty version on top, so that the last full one stays as a backup; nothing without confirm."""
        now = self.read(name)
        return self.write(name, now.limit(0)) if confirm and now is not None else None

    def needs_backup(self, name: str, since: int, threshold: int = 100) -> bool:
        """Whether threshold rows or more have come since a version."""
        versions = self.versions(name)
        return bool(versions) and since in versions and self.read(name).count() - self.read(name, since).count() >= threshold


def export_registry(tables: dict[str, DataFrame], path: str) -> None:
    """One folder of quoted CSV per table."""
    for name, df in tables.items():
        export_csv(df, f"{path}/{name}")


_BLOCK = "map<string,array<struct<name:string,player1:string,player2:string>>>"


def _stat(json_text, name: str, player: int):
    """A cell of a stats document's first block: set0, else the first."""
    blocks = F.from_json(F.get_json_object(json_text, "$.setStats"), _BLOCK)
    rows = F.coalesce(F.try_element_at(blocks, F.lit("set0")), F.element_at(F.map_values(blocks), 1))
    return F.get(F.filter(rows, lambda r: r["name"] == name), 0)[f"player{player}"]


def side_stats(json_text, name: str, player: int):
    """A named number of the first set block of a stats document: '7', or the numerator of '12/20 (60%)'."""
    return F.regexp_extract(_stat(json_text, name, player), r"^(\d+)", 1).try_cast("int")


def side_total(json_text, name: str, player: int):
    """The denominator of '12/20 (60%)'."""
    return F.regexp_extract(_stat(json_text, name, player), r"^\d+/(\d+)", 1).try_cast("int")


def match_stats(df: DataFrame, json_text: str, stats: dict[str, str], totals: dict[str, str] | None = None, ids: tuple[str, str] = ("player1_id", "player2_id")) -> DataFrame:
    """df and p1_, p2_ columns of a stats document, each for the side whose id the document names; null where it names neither.

    stats: names in the document to columns; totals: those whose denominator is a column too. A statistic that the document
    lacks is 0, a document that can't be read gives nulls.
    """
    text = F.col(json_text)
    who = lambda i: F.upper(F.trim(F.get_json_object(text, f"$.players[{i - 1}].player1Id")))
    own = lambda p: F.upper(F.trim(F.col(ids[p - 1]).cast("string")))
    read = F.from_json(F.get_json_object(text, "$.setStats"), _BLOCK).isNotNull()
    new = {}
    for p in (1, 2):
        for of, table in ((side_stats, stats), (side_total, totals or {})):
            for name, column in table.items():
                value = lambda i, of=of, name=name: F.when(read, F.coalesce(of(text, name, i), F.lit(0)))
                new[f"p{p}_{column}"] = F.when(who(1) == own(p), value(1)).when(who(2) == own(p), value(2))
    return df.withColumns(new)
