"""Start a build, publish its result, or make a synthetic delivery.

    spark-submit --py-files borderlake.zip lakehouse.py build ROOT CUSTOMERS TRANSACTIONS
    spark-submit --py-files borderlake.zip lakehouse.py publish ROOT TARGET
    spark-submit --py-files borderlake.zip lakehouse.py generate TARGET

The zip holds the folder ``borderlake``. A build needs TOKENIZATION_KEY.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from borderlake.functions.residency import load_policy
from borderlake.operators.contracts import GOVERNANCE, folder
from borderlake.plans.pipeline import run
from borderlake.plans.publication import publish_lake
from borderlake.sources import synthetic
from borderlake.sources.lake import Lake


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    commands = parser.add_subparsers(dest="command", required=True)
    build = commands.add_parser("build")
    build.add_argument("root")
    build.add_argument("customers")
    build.add_argument("transactions")
    publish = commands.add_parser("publish")
    publish.add_argument("root")
    publish.add_argument("target")
    for command in (build, publish):
        command.add_argument("--governance", default=GOVERNANCE, help="folder of contracts and residency policy")
    generate = commands.add_parser("generate")
    generate.add_argument("target")
    generate.add_argument("--transactions", type=int, default=synthetic.N_TRANSACTIONS)
    generate.add_argument("--customers", type=int, default=synthetic.N_CUSTOMERS)
    generate.add_argument("--crossings", type=int, default=synthetic.N_CROSSINGS)
    generate.add_argument("--sound", action="store_true", help="without the known faults")
    return parser.parse_args()


def main() -> None:
    given = arguments()
    spark = SparkSession.builder.appName("borderlake").getOrCreate()
    if given.command == "generate":
        paths = synthetic.write_delivery(
            spark, given.target, given.transactions, given.customers, given.crossings, not given.sound
        )
        print(*paths.values(), sep="\n")
        return
    lake = Lake(spark, given.root)
    lake.attach()
    if given.command == "publish":
        policy = load_policy(folder(given.governance) / "residency.yml")
        publish_lake(lake, policy, given.target).show(truncate=False)
        return
    deliveries = {"customers": given.customers, "transactions": given.transactions}
    print(run(lake, deliveries, given.governance))


if __name__ == "__main__":
    main()
