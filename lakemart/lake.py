"""The context every model function receives: source tables below, finished models above."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession

from lakemart.session import apply_defaults
from lakemart.sources.files import read_zone
from lakemart.sources.keymap import KeyMap
from lakemart.sources.reconcile import read_reconciled
from lakemart.sources.releases import Releases
from lakemart.sources.standin import standin_source


class Lake:
    """Resolves names to DataFrames, each built once per lake.

    Most frames are lazy. Building a model that ranks its rows, or the backlog, writes scratch tables at once.

    A model that was staged or published is read back from its gold folder from then on: later models start from its
    files, with exact sizes for the join planner, instead of repeating its plan. The lake keeps to the release it found
    when it first read gold; what it stages itself comes on top. Others see staged models when ``release`` names them.
    """

    def __init__(self, spark: SparkSession, source: Callable[[str], DataFrame], gold: str | None = None, keys: str | None = None, buckets: int | None = None):
        """``keys`` is a folder for surrogate keys that outlive a rebuild; without it every build numbers anew.

        ``buckets`` lays out the facts in gold by order, in so many buckets: joins of facts then move no lines. Choose it
        so that a bucket of the largest fact fits in a task, and keep it.
        """
        self.spark = apply_defaults(spark)
        self.gold = gold
        self.keys = keys
        self.buckets = buckets
        self.measured: dict[str, dict[str, int]] = {}
        self._read_source = source
        self._frames: dict[str, DataFrame] = {}
        self._staged: dict[str, str] = {}
        self._published: set[str] = set()
        self._pinned: tuple[int, dict[str, str]] | None = None

    @classmethod
    def from_silver(cls, spark: SparkSession, silver: str, gold: str | None = None, reconcile: bool = False) -> Lake:
        """``reconcile`` reads files whose columns differ from the declared ones, at the price of a look at each day."""
        read = read_reconciled if reconcile else read_zone
        return cls(spark, lambda table: read(spark, silver, table), gold)

    @classmethod
    def from_days(cls, ledger, gold: str | None = None) -> Lake:
        """A lake over the whole days that a ledger knows now; days that come in later are not seen."""
        return cls(ledger.spark, ledger.source(), gold)

    @classmethod
    def from_gold(cls, spark: SparkSession, gold: str) -> Lake:
        """A reader of published models: all of them as the newest release has them, however long it reads."""

        def none(table: str) -> DataFrame:
            raise LookupError(f"{table}: this lake reads published models only")

        lake = cls(spark, none, gold)
        for name in lake.release_read()[1]:
            lake.open_published(name)
        return lake

    @classmethod
    def from_standin(cls, spark: SparkSession, sf_dir: str, gold: str | None = None) -> Lake:
        return cls(spark, standin_source(spark, sf_dir), gold)

    def _once(self, key: str, build: Callable[[], DataFrame]) -> DataFrame:
        if key not in self._frames:
            self._frames[key] = build()
        return self._frames[key]

    def source(self, table: str) -> DataFrame:
        return self._once(f"source {table}", lambda: self._read_source(table))

    def model(self, name: str) -> DataFrame:
        from lakemart.plans import MODELS

        return self._once(name, lambda: MODELS[name](self))

    def attributes(self, dimension: str) -> DataFrame:
        """A dimension without its surrogate key, for joins on the natural key.

        Numbering a dimension costs a global sort, which a join on the natural key does not need.
        """
        from lakemart.plans import ATTRIBUTES, SURROGATE_KEYS

        if dimension in self._published:
            return self.model(dimension).drop(SURROGATE_KEYS[dimension])
        return self._once(f"attributes {dimension}", lambda: ATTRIBUTES[dimension](self))

    def key_map(self, dimension: str) -> KeyMap | None:
        return None if self.keys is None else KeyMap(self.spark, f"{self.keys}/{dimension}")

    def sql(self, text: str, *models: str) -> DataFrame:
        """Ad-hoc SQL over models, which appear as temporary views under their own names."""
        for name in models:
            self.model(name).createOrReplaceTempView(name)
        return self.spark.sql(text)

    # --- gold -------------------------------------------------------------------------------------------------------

    @property
    def releases(self) -> Releases:
        if self.gold is None:
            raise ValueError("this lake has no gold folder")
        return Releases(self.spark, self.gold)

    def release_read(self) -> tuple[int, dict[str, str]]:
        """Number and folders of the release this lake reads."""
        if self._pinned is None:
            self._pinned = self.releases.current()
        return self._pinned

    def stage(self, name: str) -> DataFrame:
        """Write a model to a new folder of gold and use the written files from now on; readers do not see it yet.

        The write counts the model's rows and the NULLs of its required columns as they pass: ``measured``.
        """
        from lakemart.plans import LAID_OUT
        from lakemart.plans.checks import measures

        seen = Observation()
        folder = self.releases.stage(self.model(name).observe(seen, *measures(name)), name, LAID_OUT.get(name), self.buckets)
        self.measured[name] = seen.get
        self._staged[name] = folder
        self._published.add(name)
        self._frames[name] = self.releases.read(folder)
        return self._frames[name]

    def release(self) -> int:
        """Make all staged models current at once. Raises ``Conflict`` if gold changed since this lake first read it."""
        number, models = self.release_read()
        self._pinned = (self.releases.release(self._staged, after=number), models | self._staged)
        self._staged = {}
        return self._pinned[0]

    def publish(self, name: str) -> DataFrame:
        """Stage a model and make it current by itself, on top of whatever others have published."""
        self.stage(name)
        folder = self._staged.pop(name)
        self._pinned = None
        self.releases.release({name: folder})
        return self._frames[name]

    def open_published(self, name: str) -> DataFrame:
        """Read a model from gold from now on, as the release that this lake reads has it."""
        self._frames[name] = self.releases.read(self.release_read()[1][name])
        self._published.add(name)
        return self._frames[name]

    def is_written(self, name: str) -> bool:
        """Whether a model is read from its gold folder."""
        return name in self._published

    def forget_unpublished(self) -> None:
        """Build all models anew that are not in gold, e.g. after their scratch tables were deleted."""
        self._frames = {k: f for k, f in self._frames.items() if k in self._published or k.startswith("source ")}
