"""Task loss: tasks below the ordered pass fail on their first attempt; Spark retries them and the result must be
exactly the one a flight-keyed window gives (deterministic recompute)."""

import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent("""
    import sys
    sys.path.insert(0, REPO)
    from pyspark import TaskContext
    from pyspark.sql import SparkSession, Window, functions as F
    from flighttables.operators import ordered as O

    spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.execution.arrow.maxRecordsPerBatch", "7").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")

    def flaky(batches):
        tc = TaskContext.get()
        if tc.attemptNumber() == 0 and tc.partitionId() % 2 == 1:
            raise RuntimeError("simulated executor loss")
        yield from batches

    df = spark.range(600).select(F.when(F.col("id") % 9 == 0, F.lit("a")).otherwise(F.lit("hot")).alias("g"),
                                 (F.col("id") * 7 % 600).alias("o"), (F.col("id") % 5).alias("v"))
    lost = df.repartition(4).mapInArrow(flaky, df.schema)
    got = O.ordered_within(lost, ["g"], ["o"], lag_cols=["v"], lead_cols=["v"], width=6)
    w = Window.partitionBy("g").orderBy("o")
    exp = df.select("*", F.row_number().over(w).cast("bigint").alias("seq"), F.lag("v").over(w).alias("prev_v"),
                    F.lead("v").over(w).alias("next_v"))
    a = sorted(map(tuple, got.select(exp.columns).collect()), key=str)
    b = sorted(map(tuple, exp.collect()), key=str)
    print("EQUAL" if a == b and len(a) == 600 else "DIFFERENT")
""").replace("REPO", repr(REPO))


def test_ordered_pass_survives_task_retries(tmp_path):
    script = tmp_path / "retry_check.py"
    script.write_text(SCRIPT)
    out = subprocess.run([sys.executable, str(script)], capture_output=True, text=True, timeout=600,
                         cwd=str(tmp_path))
    assert "EQUAL" in out.stdout, out.stdout[-2000:] + out.stderr[-2000:]
