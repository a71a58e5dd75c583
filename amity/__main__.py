"""``spark-submit`` entry: ``python -m amity <command> ...``."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from amity import generate
from amity.functions.time import INACTIVITY_DAYS, INACTIVITY_MILLIS
from amity.operators import contract_violations, record_quality, routed_records, row_counts
from amity.plans import tasks
from amity.schemas import ACCESS_LOGS, ASSOCIATES, USERS
from amity.sinks import write_table, write_text
from amity.sources import EXACTLY_5, read_access_logs, read_associates, read_raw, read_users


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="amity", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, *inputs: str, alternative: bool = False) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        for table in inputs:
            sub.add_argument(f"--{table}", required=True)
        sub.add_argument("--out", required=True)
        if name.startswith("task-"):
            sub.add_argument("--order", choices=["numeric", "text"])
        if alternative:
            sub.add_argument("--alternative", action="store_true")
        return sub

    command("task-a", "users", alternative=True).add_argument("--nationality", default="India")
    command("task-b", "users", "logs", alternative=True).add_argument("--k", type=int, default=10)
    command("task-c", "users", alternative=True)
    command("task-d", "users", "associates", alternative=True)
    command("task-e", "logs", alternative=True)
    command("task-f", "associates", "logs")
    command("task-f-alternative", "merged").add_argument(
        "--friend-files", help="pattern of the names of files that hold friendships"
    )
    task_g = command("task-g", "logs")
    task_g.add_argument("--as-of", type=int, required=True)
    task_g.add_argument("--window", type=int, default=INACTIVITY_MILLIS)
    outputs = commands.add_parser("task-g-outputs")
    outputs.add_argument("--logs", required=True)
    outputs.add_argument("--out", required=True)
    outputs.add_argument("--as-of", type=int, required=True)
    outputs.add_argument("--window", type=int, default=INACTIVITY_MILLIS)
    command("rejected", "logs")
    minutes = command("task-g-minutes", "logs")
    minutes.add_argument("--now", type=float, required=True, help="epoch seconds")
    minutes.add_argument("--days", type=float, default=INACTIVITY_DAYS)
    task_h = command("task-h", "associates")
    task_h.add_argument("--threshold", type=int, default=1)
    task_h.add_argument("--users")
    command("quality", "users", "associates", "logs")
    made = command("generate")
    made.add_argument("--n-users", type=int, default=generate.N_USERS)
    made.add_argument("--n-associates", type=int, default=generate.N_ASSOCIATES)
    made.add_argument("--n-logs", type=int, default=generate.N_ACCESS_LOGS)
    made.add_argument("--seed", type=int, default=0)
    return parser


def quality(spark: SparkSession, users: str, associates: str, logs: str, out: str) -> None:
    """Three reports below ``out``: record shapes, data rows of whatever shape, broken rules."""
    raw = {
        "users": read_raw(spark, users, USERS),
        "associates": read_raw(spark, associates, ASSOCIATES),
        "access_logs": read_raw(spark, logs, ACCESS_LOGS),
    }
    tables = {
        "users": read_users(spark, users),
        "associates": read_associates(spark, associates),
        "access_logs": read_access_logs(spark, logs),
    }
    write_text(record_quality(raw["access_logs"]), out, name="records")
    write_text(row_counts(raw), out, name="rows")
    write_text(contract_violations(*tables.values()), out, name="violations")


def rejected(spark: SparkSession, logs: str, out: str) -> None:
    """Lines of the accesses that are no whole record, header lines left out, with the reason."""
    name = ACCESS_LOGS.fieldNames()[0]
    routed = routed_records(spark.read.text(logs), ACCESS_LOGS, EXACTLY_5)
    bad = routed.where(F.col("reason").isNotNull() & ~F.col("line").startswith(f"{name},"))
    write_text(bad.select("reason", "n_fields", "line"), out)


def task_g_outputs(spark: SparkSession, **options: str | int) -> None:
    """Prints how many records were read and could not be used."""
    print(json.dumps(tasks.task_g_outputs(spark, **options)))


def generate_tables(
    spark: SparkSession, out: str, n_users: int, n_associates: int, n_logs: int, seed: int
) -> None:
    users = generate.generate_users(spark, n_users, seed=seed)
    associates = generate.generate_associates(spark, n_users, n_associates, seed)
    logs = generate.generate_access_logs(spark, n_logs, n_users, seed)
    for name, table in (("users", users), ("associates", associates), ("access_logs", logs)):
        write_table(table, f"{out}/{name}")


COMMANDS = {
    "task-a": tasks.task_a,
    "task-b": tasks.task_b,
    "task-c": tasks.task_c,
    "task-d": tasks.task_d,
    "task-e": tasks.task_e,
    "task-f": tasks.task_f,
    "task-f-alternative": tasks.task_f_alternative,
    "task-g": tasks.task_g,
    "task-g-minutes": tasks.task_g_minutes,
    "task-g-outputs": task_g_outputs,
    "rejected": rejected,
    "task-h": tasks.task_h,
    "quality": quality,
    "generate": generate_tables,
}


def main(argv: list[str] | None = None) -> None:
    options = vars(_parser().parse_args(argv))
    job = COMMANDS[options.pop("command")]
    job(SparkSession.builder.appName("amity").getOrCreate(), **options)


if __name__ == "__main__":
    main()
