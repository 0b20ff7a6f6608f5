"""Gold as releases: models in folders that are never rewritten, and a commit that says which folders belong together.

A model is staged in a new folder. Readers find folders through the newest release only, so they see a model the moment
a release names it, and all models of a release at once. A publish that fails, or whose checks fail, leaves nothing but
unnamed folders. A reader that has pinned a release goes on reading its folders until they expire.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lakemart.sources.buckets import is_bucketed, read_bucketed, write_bucketed
from lakemart.sources.commits import CommitLog, Folder


class Releases:
    def __init__(self, spark: SparkSession, gold: str):
        self.spark = spark
        self.gold = gold.rstrip("/")
        self.log = CommitLog(spark, f"{self.gold}/_releases")

    def current(self) -> tuple[int, dict[str, str]]:
        """Number of the newest release and the folder of each of its models, below the gold folder."""
        number, models = self.log.latest()
        return number, models or {}

    def stage(self, df: DataFrame, model: str, key: str | None = None, buckets: int | None = None) -> str:
        """Write a model to a folder of its own that no reader knows yet, laid out by ``key`` if ``buckets`` are given."""
        folder = f"{model}/v-{uuid.uuid4().hex}"
        if key is not None and buckets:
            write_bucketed(df, f"{self.gold}/{folder}", key, buckets)
        else:
            df.write.parquet(f"{self.gold}/{folder}")
        return folder

    def read(self, folder: str) -> DataFrame:
        path = f"{self.gold}/{folder}"
        return read_bucketed(self.spark, path) if is_bucketed(self.spark, path) else self.spark.read.parquet(path)

    def release(self, staged: dict[str, str], after: int | None = None) -> int:
        """Make staged folders current, all at once; models that were not staged keep the folder they have.

        ``after`` is the release the caller started from: if another one came in between, ``Conflict`` is raised and
        nothing changes.
        """
        number, models = self.current()
        return self.log.commit((number if after is None else after) + 1, models | staged)

    def expire(self, keep: int = 2) -> list[str]:
        """Delete all but the newest ``keep`` releases and the folders that only they name; returns the folders.

        Folders that no release names at all, staged by a publish that failed or still runs, stay: see ``abandoned``.
        """
        entries = self.log.entries()
        old, new = entries[:-keep], entries[-keep:]
        named = {folder for _, models in new for folder in models.values()}
        gone = sorted({folder for _, models in old for folder in models.values()} - named)
        files = Folder(self.spark, self.gold)
        # The commits go first, oldest first: whatever is left still names only folders that are there.
        for number, _ in old:
            self.log.forget(number)
        for folder in gone:
            files.delete(folder)
        return gone

    def abandoned(self) -> list[str]:
        """Folders that no release names. Delete them when no publish is running."""
        named = {folder for _, models in self.log.entries() for folder in models.values()}
        found = []
        for model in Folder(self.spark, self.gold).names():
            if not model.startswith("_"):
                found += [f"{model}/{v}" for v in Folder(self.spark, f"{self.gold}/{model}").names()]
        return [folder for folder in found if folder not in named]
