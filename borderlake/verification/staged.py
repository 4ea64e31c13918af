"""Tables the registered queries start from, stored once per session and source.

The raw deliveries, the judged tables and a complete lake are derived from the
test tables by Spark and written to the shared folder, as a build would store
them. Each is made on first use, and again when a source file has changed or the
stored files are gone.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from borderlake.functions.residency import load_policy
from borderlake.operators.contracts import GOVERNANCE, load_contracts, pii_inventory
from borderlake.operators.judge import judge, quarantine
from borderlake.operators.silver import silver_customers, silver_transactions
from borderlake.plans.pipeline import ingest, transform
from borderlake.sources.delivery import write_csv
from borderlake.sources.lake import Lake, shared_folder, side_by_side
from borderlake.verification import derived

_stored: dict[tuple, dict] = {}


class Staged:
    """Access to the staged tables of one source folder."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self.contracts = load_contracts()
        self.policy = load_policy(GOVERNANCE / "residency.yml")
        self.key = derived.CHECK_KEY

    def source(self, table: str) -> DataFrame:
        return derived.source(self.spark, self.sf_dir, table)

    # --- staged tables ---------------------------------------------------------

    @property
    def bronze(self) -> dict[str, DataFrame]:
        def land() -> dict:
            folder = shared_folder(self.spark, "bronze")
            self._store(folder, derived.deliveries(self.spark, self.sf_dir))
            return {"folder": folder}

        folder = self._once("bronze", land)["folder"]
        return {name: self.spark.read.parquet(f"{folder}/{name}") for name in self.contracts}

    @property
    def judged(self) -> dict[str, DataFrame]:
        def make() -> dict:
            folder = shared_folder(self.spark, "judged")
            judge(self.bronze, self.contracts, lambda frames: self._store(folder, frames))
            return {"folder": folder}

        folder = self._once("judged", make)["folder"]
        return {name: self.spark.read.parquet(f"{folder}/{name}_judged") for name in self.contracts}

    @property
    def lake(self) -> Lake:
        return self._lake()["lake"]

    def _lake(self) -> dict:
        def build() -> dict:
            lake, csv = self.new_lake(), self.new_delivery()
            ingest(lake, csv)
            transform(lake, self.contracts, self.policy, self.key)
            return {"folder": lake.root, "lake": lake}

        return self._once("lake", build)

    @property
    def quarantine(self) -> DataFrame:
        """Stored, as a build stores it; the query of that name makes it anew."""

        def make() -> dict:
            folder = shared_folder(self.spark, "quarantine")
            self._store(folder, {"quarantine": quarantine(self.judged, self.contracts, self.policy)})
            return {"folder": folder}

        return self.spark.read.parquet(f"{self._once('quarantine', make)['folder']}/quarantine")

    # --- derived from them, not stored --------------------------------------------

    @property
    def customers(self) -> DataFrame:
        return silver_customers(self.judged["customers"], self.contracts["customers"], self.key)

    @property
    def transactions(self) -> DataFrame:
        return silver_transactions(self.judged["transactions"], self.contracts["transactions"], self.policy)

    @property
    def inventory(self) -> DataFrame:
        return pii_inventory(self.spark, self.contracts)

    # --- helpers --------------------------------------------------------------------

    def new_lake(self) -> Lake:
        root = shared_folder(self.spark, "lake")
        return Lake(self.spark, root, prefix=f"check{root.rsplit('-', 1)[1].lower()}_")

    def new_delivery(self) -> dict[str, str]:
        folder = shared_folder(self.spark, "delivery")
        jobs = [partial(write_csv, t, t.columns, f"{folder}/{name}.csv") for name, t in self.bronze.items()]
        side_by_side(self.spark, jobs)
        return {name: f"{folder}/{name}.csv" for name in self.contracts}

    def _store(self, folder: str, frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
        def store(name: str) -> DataFrame:
            frames[name].write.parquet(f"{folder}/{name}")
            return self.spark.read.parquet(f"{folder}/{name}")

        return dict(zip(frames, side_by_side(self.spark, [partial(store, name) for name in frames]), strict=True))

    def _once(self, step: str, make: Callable[[], dict]) -> dict:
        versions = tuple(self._version(t) for t in ("customer", "orders"))
        key = (self.spark.sparkContext.applicationId, self.sf_dir, versions, step)
        if key not in _stored or not self._exists(_stored[key]["folder"]):
            _stored[key] = make()
        return _stored[key]

    def _version(self, table: str) -> tuple[int, int]:
        path, fs = self._file(f"{self.sf_dir}/{table}.parquet")
        status = fs.getFileStatus(path)
        return status.getLen(), status.getModificationTime()

    def _exists(self, folder: str) -> bool:
        path, fs = self._file(folder)
        return fs.exists(path)

    def _file(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())
