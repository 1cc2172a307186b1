"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose input and cores.
Each query is built and its whole result computed; a first untimed query warms the session up.

The posts of the test tables lie in one row group, so one task reads them all. The queries that work on
text are therefore timed a second time over a copy of that table in as many files as there are cores
("in_files"); the copy is made untimed. The main figure is that of the tables as they are.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tickerpulse.session import build_session, scratch_path  # noqa: E402
from workload.catalog import QUERIES  # noqa: E402

HEADLINE = (
    "a1_score_and_roll_up", "a1_daily_polarity", "a2_redelivered_once", "a5_progress_per_term",
    "a7_posts_over_time_per_term", "a10_sentiment_share", "a18_word_counts", "a19_trending_hashtags",
    "f1_clean_document", "f2_clean_without_stopwords", "f5_sentiment_clean", "f5_sentiment_raw",
    "f5_sentiment_lexicon_table", "f6_weighted_polarity", "f13_parse_created", "j1_last_ticker_of_post",
    "j3_prices_with_polarity", "j6_unmatched_days", "t4_companies_trolled", "p15_positional_sample",
    "w1_sma", "w2_ema", "w3_macd", "w4_rsi", "w5_target", "w7_chronological_split", "w9_feature_frame",
    "r1_score_stream", "r2_two_sinks", "r6_term_counts_stream", "s5_json_round_trip", "s16_split_files",
)

ON_TEXT = (
    "a1_score_and_roll_up", "a10_sentiment_share", "a18_word_counts", "f1_clean_document", "f2_clean_without_stopwords",
    "f5_sentiment_clean", "f5_sentiment_raw", "f5_sentiment_lexicon_table", "f6_weighted_polarity", "j3_prices_with_polarity",
    "t4_companies_trolled", "s16_split_files",
)


def in_files(spark, sf: str, files: int) -> str:
    """A folder like ``sf`` whose posts are dealt to so many files."""
    folder = scratch_path(spark, "bench")
    spark.read.parquet(f"{sf}/documents.parquet").repartition(files).write.parquet(f"{folder}/documents.parquet")
    for name in os.listdir(sf):
        if name != "documents.parquet":
            os.symlink(os.path.join(os.path.abspath(sf), name), os.path.join(folder, name))
    return folder


def timed(spark, sf: str, names) -> dict[str, float]:
    seconds = {}
    for name in names:
        start = time.time()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    return seconds


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["a3_total_posts"](spark, sf).collect()
    only = sys.argv[1:]
    seconds = timed(spark, sf, [n for n in HEADLINE if not only or n in only])
    dealt = timed(spark, in_files(spark, sf, int(cpus)), [n for n in ON_TEXT if n in seconds])
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total wall time of the headline queries", "value": total, "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
                      "cpus": int(cpus), "in_files": {"value": round(sum(dealt.values()), 3), "queries": dealt}}))
    spark.stop()


if __name__ == "__main__":
    main()
