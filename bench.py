"""Wall seconds of the headline queries. Prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default all), BENCH_QUERIES (optional,
comma separated).
"""

from __future__ import annotations

import json
import os
import sys
import time

from crowdpulse.plans.queries import queries
from crowdpulse.session import build_session

HEADLINE = (
    "parse_events", "post_roots", "engagement_totals", "active_posts", "active_posts_people",
    "static_scores", "dynamic_scores", "friend_recommendations", "unique_word_ratio",
    "low_vocabulary_spam", "burst_spam", "periodic_snapshot", "sliding_sum",
)
# Measured as well, beside the total that earlier rounds are compared by.
ALSO = (
    "burst_counts", "running_vocabulary_threshold", "spammers", "stream_post_trees", "stream_active_posts",
    "stream_friend_recommendations", "stream_spammers",
)


def shuffle_bytes(spark) -> int:
    """What all tasks have written for shuffles so far."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    executors = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()
    spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("event_type").count().collect()  # start the engine
    seconds, also, megabytes = {}, {}, {}
    for name in [*names, *([] if os.environ.get("BENCH_QUERIES") else ALSO)]:
        start = time.perf_counter()
        before = shuffle_bytes(spark)
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        (seconds if name in names else also)[name] = round(time.perf_counter() - start, 3)
        megabytes[name] = round((shuffle_bytes(spark) - before) / 1e6, 2)
    spark.stop()
    print(json.dumps({
        "metric": "total wall time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "beside": also,
        "shuffle_mb": megabytes,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    return 0


if __name__ == "__main__":
    sys.exit(main())
