"""Wall time of the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fixtures import capture, messages  # noqa: E402
from rowtide.operators import filters, outbox, results, routing, sheets  # noqa: E402
from rowtide.plans import changes  # noqa: E402
from rowtide.session import configure, write_shared  # noqa: E402
from suite import ENTRIES  # noqa: E402
from suite.base import TABLES, table  # noqa: E402
from suite.sources import SQL_TEXTS  # noqa: E402
from rowtide.sources.tables import register_tables, run_sql  # noqa: E402


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cores)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    register_tables(spark, folder, TABLES)

    # Captured inputs, as a capture job would have left them: many files.
    parts = int(cores) * 2
    frames = write_shared(capture.change_frames(spark, folder).repartition(parts), "bench-frames")
    wide = write_shared(capture.lineitem_rows(table(spark, folder, "lineitem")).repartition(parts), "bench-lines")
    notify = write_shared(messages.notify_messages(spark, folder).repartition(parts), "bench-notify")
    rows = {
        "decode": frames.count(),
        "decode_lineitem": wide.count(),
        "forward_kafka": frames.count(),
        "route_rabbitmq": notify.count(),
        "route_kafka": notify.count(),
        "route_shell": notify.count(),
        "render_lineitem": table(spark, folder, "lineitem").count(),
    }
    rows["render_csv"] = rows["sheets"] = rows["render_lineitem"]

    def forward():
        rule = filters.should_forward(tables=["orders"], ops=["insert", "update"])
        return outbox.to_kafka(filters.forwardable(changes.decode_changes(frames, where=rule), rule))

    def csv():
        path = write_shared(spark.range(1), "bench-csv").inputFiles()[0].rsplit("/", 1)[0]
        results.write_csv(results.render(table(spark, folder, "lineitem")), f"{path}/out")

    jobs = {
        "decode": lambda: consume(changes.decode_changes(frames)),
        "decode_lineitem": lambda: consume(changes.decode_changes(wide)),
        "forward_kafka": lambda: consume(forward()),
        "route_rabbitmq": lambda: consume(routing.to_rabbitmq(notify, "contract")),
        "route_kafka": lambda: consume(routing.to_kafka(notify, "contract")),
        "route_shell": lambda: consume(routing.to_shell(notify, "run", "contract")),
        "render_lineitem": lambda: consume(results.render(table(spark, folder, "lineitem"))),
        "render_csv": csv,
        "sheets": lambda: consume(
            sheets.split_sheets(results.render(run_sql(spark, "SELECT * FROM lineitem")), 100_000)
        ),
        "confirmed_position": lambda: consume(ENTRIES["T1_confirmed_position"].run(spark, folder)),
    }
    for name, text in SQL_TEXTS.items():
        jobs[name] = lambda text=text: consume(run_sql(spark, text))

    times, rates = {}, {}
    for name, job in jobs.items():
        job()  # code generation and caches
        started = time.time()
        job()
        times[name] = round(time.time() - started, 3)
        if name in rows:
            rates[name] = int(rows[name] / times[name])
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "rows_per_sec": rates,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
