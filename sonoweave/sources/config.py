"""Dataset configuration and population statistics as tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonoweave.schemas import DATASETS, POPULATION_STATS

DEFAULT_TEXT_EXT = ".txt"
_FIELDS = ("name", "path", "lang", "style", "text_ext")


def parse_datasets(text: str) -> list[dict[str, str]]:
    """The entries of ``datasets:`` in a YAML text; none if the key is missing.

    The installed YAML library is used if there is one, else the subset that such files need: a list of flat
    mappings of plain or quoted scalars.
    """
    try:
        import yaml

        return list((yaml.safe_load(text) or {}).get("datasets") or [])
    except ImportError:
        pass
    entries: list[dict[str, str]] = []
    inside = False
    for raw in text.splitlines():
        line = raw.split(" #")[0].rstrip() if not raw.lstrip().startswith("#") else ""
        if not line.strip():
            continue
        if not line[0].isspace() and not line.startswith("-"):
            inside = line.strip() == "datasets:"
            continue
        if not inside:
            continue
        item = line.strip()
        if item.startswith("- "):
            entries.append({})
            item = item[2:]
        key, _, value = item.partition(":")
        if entries and value.strip():
            entries[-1][key.strip()] = value.strip().strip("\"'")
    return entries


def read_datasets(spark: SparkSession, path: str) -> DataFrame:
    """``name, path, lang, style, text_ext`` of a YAML file; an absent ``text_ext`` is ``.txt``.  A fixed, small table."""
    text = "\n".join(r.value for r in spark.read.text(path).collect())
    rows = [tuple(e.get(f) if f != "text_ext" else e.get(f) or DEFAULT_TEXT_EXT for f in _FIELDS) for e in parse_datasets(text)]
    return spark.createDataFrame(rows, DATASETS)


def with_default_ext(datasets: DataFrame) -> DataFrame:
    """A dataset table with the default put in for a null ``text_ext``."""
    return datasets.withColumn("text_ext", F.coalesce("text_ext", F.lit(DEFAULT_TEXT_EXT)))


def read_stats(spark: SparkSession, path: str) -> DataFrame:
    """Population statistics of a JSON file ``{group: {feature: {n, mean, std}}}``; members that are no groups (a comment) are dropped."""
    whole = spark.read.text(path, wholetext=True)
    groups = whole.select(F.explode(F.from_json("value", "map<string,string>")).alias("lang_style", "g"))
    features = groups.select("lang_style", F.explode(F.from_json("g", "map<string,struct<n:bigint,mean:double,std:double>>")).alias("feature", "s"))
    return features.where("s IS NOT NULL AND s.n IS NOT NULL").select("lang_style", "feature", "s.n", "s.mean", "s.std")


def stats_json(stats: DataFrame) -> str:
    """The statistics as JSON text: groups and features sorted, six decimals.

    Collected to the driver: one row per group and feature, which configuration bounds.
    """
    out: dict[str, dict] = {}
    for r in sorted(stats.select("lang_style", "feature", "n", "mean", "std").collect(), key=lambda r: (r[0], r[1])):
        out.setdefault(r["lang_style"], {})[r["feature"]] = {"n": r["n"], "mean": round(r["mean"], 6), "std": round(r["std"], 6)}
    return json.dumps(out, indent=2, ensure_ascii=False)


def write_stats(stats: DataFrame, path: str) -> None:
    """Write :func:`stats_json` as one text file into the folder ``path``."""
    spark = stats.sparkSession
    spark.createDataFrame([(stats_json(stats),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def empty_stats(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], POPULATION_STATS)


# Statistics of a small sample, used until a calibration replaces them; (n, mean, std) by group and feature.
DEFAULT_POPULATION_STATS = {
    "zh_read": {
        "speed": (13, 4.88, 0.45), "energy": (13, 0.031, 0.016), "loudness_lufs": (13, -18.3, 3.6),
        "duration": (13, 2.93, 2.37), "word_duration": (155, 0.195, 0.072), "word_energy": (155, 0.031, 0.025),
    },
    "en_read": {
        "speed": (9, 2.88, 0.58), "energy": (9, 0.020, 0.003), "loudness_lufs": (9, -20.3, 1.1),
        "duration": (9, 3.58, 2.77), "word_duration": (88, 0.318, 0.214), "word_energy": (88, 0.021, 0.012),
    },
    "zh_emotion": {
        "speed": (5, 5.73, 0.96), "energy": (5, 0.020, 0.011), "loudness_lufs": (5, -23.8, 5.2),
        "duration": (5, 2.91, 0.91), "word_duration": (74, 0.162, 0.073), "word_energy": (74, 0.020, 0.015),
    },
    "en_emotion": {
        "speed": (7, 3.72, 0.74), "energy": (7, 0.010, 0.003), "loudness_lufs": (7, -27.9, 3.3),
        "duration": (7, 1.16, 0.36), "word_duration": (29, 0.244, 0.178), "word_energy": (29, 0.011, 0.008),
    },
}


def default_stats(spark: SparkSession) -> DataFrame:
    rows = [(g, f, n, m, s) for g, features in DEFAULT_POPULATION_STATS.items() for f, (n, m, s) in features.items()]
    return spark.createDataFrame(rows, POPULATION_STATS)
