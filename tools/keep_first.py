"""Times four forms of keep-first (W2) over the raw sales rows of a scale, each row with a unique long position.

    python tools/keep_first.py /root/testdata/sf0.1 [copies of a third of the rows under one key: 0 or 1]

``struct``: one aggregate of min(struct(position, values)), as the library does.  ``two_phase``: a hash aggregate of the
least position, then the winners' values by a semi join on it.  ``lone_keys``: keys counted by a hash aggregate, rows of keys that one row
holds pass as they are, the others go through ``struct``; needs no unique position.  ``window``: row number by key, first row kept.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, Window, functions as F

from salesmart.operators import dedup as DD
from salesmart.operators.sales import RAW
from salesmart.plans.fixtures import raw_sales
from salesmart.session import build_session, write_stage

KEYS = ["transaction_id", "product_id"]
VALUES = [c for c in RAW if c not in KEYS]


def struct(df: DataFrame) -> DataFrame:
    return DD.first_row_per_key(df, KEYS, VALUES)


def two_phase(df: DataFrame) -> DataFrame:
    first = df.groupBy(*KEYS).agg(F.min(DD.ORD).alias(DD.ORD)).select(DD.ORD)
    return df.join(first.hint("shuffle_hash"), DD.ORD, "left_semi").select(*KEYS, *VALUES, DD.ORD)


def lone_keys(df: DataFrame) -> DataFrame:
    several = df.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*[F.col(k).alias(f"_{k}") for k in KEYS])
    same = [df[k].eqNullSafe(several[f"_{k}"]) for k in KEYS]
    return df.join(several, same, "left_anti").select(*KEYS, *VALUES, DD.ORD).unionByName(struct(df.join(several, same, "left_semi")))


def window(df: DataFrame) -> DataFrame:
    row = F.row_number().over(Window.partitionBy(*KEYS).orderBy(DD.ORD))
    return df.withColumn("_row", row).filter("_row = 1").select(*KEYS, *VALUES, DD.ORD)


def main() -> None:
    sf_dir, hot = sys.argv[1], len(sys.argv) > 2 and sys.argv[2] == "1"
    spark = build_session("local[8]", 16, extra={"spark.driver.memory": "12g"})
    raw = raw_sales(spark, sf_dir)
    rows = write_stage(raw.select(*RAW).withColumn(DD.ORD, F.monotonically_increasing_id()), "keep-first")
    if hot:
        one = F.col(DD.ORD) % 3 == 0
        rows = write_stage(rows.select(*[F.when(one, F.lit("hot")).otherwise(F.col(c)).alias(c) if c in KEYS else c for c in rows.columns]), "keep-first-hot")
    digests = {}
    for turn in range(3):
        for form in (struct, two_phase, lone_keys, window):
            t0 = time.perf_counter()
            form(rows).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - t0
            digests.setdefault(form.__name__, form(rows).agg(F.count("*"), F.sum(F.xxhash64(*KEYS, *VALUES, DD.ORD).cast("decimal(38,0)"))).first() if not turn else None)
            print(f"{'warm-up' if not turn else turn} {form.__name__}: {took:.2f} s")
    print("equal results:", len(set(digests.values())) == 1, "rows:", rows.count())
    spark.stop()


if __name__ == "__main__":
    main()
