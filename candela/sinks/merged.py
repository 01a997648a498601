"""A keyed table that stream batches amend.

A row says about its key what some of the input says, and ``merge`` makes one row for each key out
of several (the latest quote, the earliest poll, a bar out of partial bars).  A batch only adds its own
rows, as one *run*; reading merges runs and base.  Nothing is ever too late: an old key is amended
like any other.  When ``fold_after`` runs have gathered, they are merged into the *base*, whose rows lie in
hash buckets: only the buckets that the runs touch are rewritten, and a manifest names the version
of each bucket.

    runs/batch_id=<n>/bucket=<b>/     rows of batch n, written in overwrite mode
    base/v=<version>/bucket=<b>/      merged rows of a bucket
    manifest/<version>.json           version of every bucket, and the last batch in the base

A replayed batch overwrites its run.  Only runs of earlier batches, which the stream has committed, are folded, and
the manifest is renamed into place after its buckets are whole, so a crash at any point loses nothing and counts
nothing twice.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candela.sinks.writers import _fs, list_dirs

BUCKETS = 64
#: Runs that gather before they are merged into the base.
FOLD_AFTER = 8
#: Manifests (and what they name) that stay for readers that have begun.
KEEP_MANIFESTS = 3


def _numbers(spark: SparkSession, path: str, prefix: str) -> list[int]:
    return sorted(int(n[len(prefix):]) for n in list_dirs(spark, path) if n.startswith(prefix))


class MergedTable:
    """``merge`` takes and returns rows of ``schema``, one for each ``keys``; merging in parts gives the same as at once."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str],
                 merge: Callable[[DataFrame], DataFrame], buckets: int = BUCKETS, fold_after: int = FOLD_AFTER):
        self.spark, self.path, self.schema, self.keys, self.merge = spark, path.rstrip("/"), schema, list(keys), merge
        self.buckets, self.fold_after = buckets, fold_after

    # ------------------------------------------------------------ small files
    def _delete(self, path: str) -> None:
        fs, p = _fs(self.spark, path)
        fs.delete(p, True)

    def _manifests(self) -> list[int]:
        fs, p = _fs(self.spark, f"{self.path}/manifest")
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("."))

    def _manifest(self, version: int | None = None) -> dict:
        """The newest manifest, or that of a version; ``buckets`` maps a bucket to its version."""
        done = self._manifests()
        if version is None and not done:
            return {"version": 0, "through": -1, "buckets": {}}
        raw = self.spark.read.text(f"{self.path}/manifest/{done[-1] if version is None else version}.json", wholetext=True).first()[0]
        return json.loads(raw)

    def _put_manifest(self, manifest: dict) -> None:
        fs, to = _fs(self.spark, f"{self.path}/manifest/{manifest['version']}.json")
        _, tmp = _fs(self.spark, f"{self.path}/manifest/.{manifest['version']}.tmp")
        out = fs.create(tmp, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        fs.rename(tmp, to)

    # ------------------------------------------------------------ rows
    def _written(self, df: DataFrame, path: str) -> None:
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        df.withColumn("bucket", bucket).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def _runs(self, after: int, before: int | None) -> list[int]:
        """Whole runs of batches after and before these."""
        out = []
        for n in _numbers(self.spark, f"{self.path}/runs", "batch_id="):
            fs, p = _fs(self.spark, f"{self.path}/runs/batch_id={n}/_SUCCESS")
            if n > after and (before is None or n < before) and fs.exists(p):
                out.append(n)
        return out

    def amend(self, rows: DataFrame, batch_id: int) -> None:
        """Adds what a batch says; a batch that comes again replaces what it said."""
        manifest = self._manifest()
        if batch_id <= manifest["through"]:
            return                       # committed long ago: its rows are in the base
        ready = self._runs(manifest["through"], batch_id)
        if len(ready) >= self.fold_after:
            self._fold(manifest, ready)
        self._written(self.merge(rows.select(*self.schema.names)), f"{self.path}/runs/batch_id={batch_id}")

    def _fold(self, manifest: dict, runs: list[int]) -> None:
        version = manifest["version"] + 1
        folders = [f"{self.path}/runs/batch_id={n}" for n in runs]
        touched = sorted({b for f in folders for b in _numbers(self.spark, f, "bucket=")})
        base = [f"{self.path}/base/v={manifest['buckets'][str(b)]}/bucket={b}" for b in touched if str(b) in manifest["buckets"]]
        new = [f"{f}/bucket={b}" for f in folders for b in _numbers(self.spark, f, "bucket=")]
        if new:
            self._written(self.merge(self._read([*base, *new])), f"{self.path}/base/v={version}")
        self._put_manifest({"version": version, "through": runs[-1],
                            "buckets": manifest["buckets"] | {str(b): version for b in touched}})
        self._clean(manifest["through"])

    def _clean(self, through: int) -> None:
        """Deletes runs that were in the base before the last fold, and buckets that no kept manifest names."""
        for n in _numbers(self.spark, f"{self.path}/runs", "batch_id="):
            if n <= through:
                self._delete(f"{self.path}/runs/batch_id={n}")
        versions = self._manifests()
        old, kept = versions[:-KEEP_MANIFESTS], versions[-KEEP_MANIFESTS:]
        named = {(b, v) for m in kept for b, v in self._manifest(m)["buckets"].items()} if old else set()
        for m in old:
            for b, v in self._manifest(m)["buckets"].items():
                if (b, v) not in named:
                    self._delete(f"{self.path}/base/v={v}/bucket={b}")
            self._delete(f"{self.path}/manifest/{m}.json")

    def read(self) -> DataFrame:
        """One row for each key, out of the base and all runs since."""
        manifest = self._manifest()
        paths = [f"{self.path}/base/v={v}/bucket={b}" for b, v in manifest["buckets"].items()]
        for n in self._runs(manifest["through"], None):
            paths += [f"{self.path}/runs/batch_id={n}/bucket={b}" for b in _numbers(self.spark, f"{self.path}/runs/batch_id={n}", "bucket=")]
        return self.merge(self._read(paths))
