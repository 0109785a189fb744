"""``python -m sonoweave control-text|calibrate --data DIR --out PATH [--number] [--max-per-clause N] [--audio DIR | --frames PATH]
[--extractors A,B]`` (also for spark-submit)."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from sonoweave.operators import calibrate, controls, segments
from sonoweave.plans.builder import BUILT_IN, ControlBuilder, Inputs, Options
from sonoweave.session import table
from sonoweave.sources import config, tree


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="sonoweave", description=__doc__)
    parser.add_argument("task", choices=("control-text", "calibrate"))
    parser.add_argument("--data", required=True, help="folder with segments, utterances and, if there are any, population_stats and emotion_scores")
    parser.add_argument("--out", required=True, help="folder to write; must not exist yet for control text")
    parser.add_argument("--number", action="store_true", help="numbers instead of labels")
    parser.add_argument("--max-per-clause", type=int, default=None, metavar="N")
    parser.add_argument("--stats", help="JSON of population statistics; default: the table of the folder, else the built-in sample")
    parser.add_argument("--audio", metavar="DIR", help="recordings, for energy and loudness")
    parser.add_argument("--frames", metavar="PATH", help="parquet of frames: utt_id, sr, hop, energy, f0_hop, f0")
    parser.add_argument("--extractors", default=",".join(BUILT_IN), metavar="A,B", help="default: all seven; one whose table is missing is an error")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("sonoweave").getOrCreate()
    rows = segments.listed_rows(table(spark, args.data, "segments"))
    utterances = table(spark, args.data, "utterances")
    frames = spark.read.parquet(args.frames) if args.frames else tree.utterance_frames(spark, args.audio, utterances) if args.audio else None
    if args.task == "calibrate":
        loudness = tree.clause_loudness(spark, args.audio, rows, utterances) if args.audio else None
        config.write_stats(calibrate.calibrate(rows, utterances, frames, loudness), args.out)
        return
    known = lambda name: spark._jvm.org.apache.hadoop.fs.Path(f"{args.data}/{name}.parquet")
    there = lambda name: known(name).getFileSystem(spark._jsc.hadoopConfiguration()).exists(known(name))
    stats = config.read_stats(spark, args.stats) if args.stats else table(spark, args.data, "population_stats") if there("population_stats") else config.default_stats(spark)
    scores = table(spark, args.data, "emotion_scores") if there("emotion_scores") else None
    inputs = Inputs(rows, controls.about_utterances(utterances), stats, frames, scores)
    ControlBuilder(Options(args.number, args.max_per_clause), args.extractors.split(",")).build(inputs).write.mode("errorifexists").parquet(args.out)


if __name__ == "__main__":
    main()
