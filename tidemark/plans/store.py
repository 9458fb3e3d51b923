"""Versioned parquet tables.

Parquet has no row-level change and a path cannot be overwritten while it is
read, so a commit writes a new segment and then one small manifest that names
the directories the new version consists of.  Directories a commit did not
replace are carried over, hence a build rewrites only the hash buckets its keys
fall into, closed history is append-only, and an added column changes nothing
but the manifest.  Readers see the newest manifest; a failed run leaves none.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.spec import TableSpec

ALL, CURRENT, CLOSED = "all", "current", "closed"


@dataclass(frozen=True)
class Piece:
    """One directory of a version."""

    segment: str
    part: str
    bucket: int

    @property
    def path(self) -> str:
        return f"_seg={self.segment}/_part={self.part}/_bucket={self.bucket}"


@dataclass(frozen=True)
class Version:
    number: int
    schema: T.StructType
    pieces: tuple[Piece, ...]
    buckets: int
    notes: dict = field(default_factory=dict)


def bucketed(spec: TableSpec) -> bool:
    return bool(spec.keys) and spec.buckets > 1


def bucket_of(spec: TableSpec) -> Column:
    if not bucketed(spec):
        return F.lit(0)
    return F.pmod(F.hash(*[F.col(f"`{k}`") for k in spec.keys]), F.lit(spec.buckets))


def bucket_sizes(keyed: DataFrame, spec: TableSpec) -> dict[int, int]:
    """Rows per bucket, at most ``spec.buckets`` entries."""
    found = keyed.groupBy(bucket_of(spec).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
    return {row["b"]: row["n"] for row in found}


def touched_buckets(keyed: DataFrame, spec: TableSpec) -> list[int] | None:
    """Buckets the keys of ``keyed`` fall into; ``None`` is all."""
    return sorted(bucket_sizes(keyed, spec)) if bucketed(spec) else None


class TableStore:
    """Layer tables under ``base/<SOURCE_DB>_<LAYER>/<TABLE>``."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    # -- naming -------------------------------------------------------------

    def root(self, spec: TableSpec, layer: str) -> str:
        return f"{self.base}/{spec.namespace(layer)}/{spec.target_table}"

    def view_name(self, spec: TableSpec, layer: str) -> str:
        return f"{spec.namespace(layer)}__{spec.target_table}"

    # -- files --------------------------------------------------------------

    def _fs(self, path: str):
        jvm, context = self.spark.sparkContext._jvm, self.spark.sparkContext
        target = jvm.org.apache.hadoop.fs.Path(path)
        return target, target.getFileSystem(context._jsc.hadoopConfiguration())

    def _names(self, path: str) -> list[str]:
        target, fs = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []

    # -- versions -----------------------------------------------------------

    def version(self, spec: TableSpec, layer: str, number: int | None = None) -> Version | None:
        """The newest version, or version ``number``."""
        folder = f"{self.root(spec, layer)}/versions"
        known = sorted(int(n[1:-5]) for n in self._names(folder) if n.startswith("v") and n.endswith(".json"))
        if not known:
            return None
        number = known[-1] if number is None else number
        target, fs = self._fs(f"{folder}/v{number:08d}.json")
        stream = fs.open(target)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        body = json.loads(text)
        return Version(
            number=number,
            schema=T.StructType.fromJson(body["schema"]),
            pieces=tuple(Piece(*p) for p in body["pieces"]),
            buckets=body["buckets"],
            notes=body["notes"],
        )

    def _publish(self, spec: TableSpec, layer: str, version: Version) -> None:
        """Write a manifest under its final name by rename; a second writer fails."""
        folder = f"{self.root(spec, layer)}/versions"
        body = json.dumps(
            {
                "schema": version.schema.jsonValue(),
                "pieces": [[p.segment, p.part, p.bucket] for p in version.pieces],
                "buckets": version.buckets,
                "notes": version.notes,
            }
        )
        draft, fs = self._fs(f"{folder}/.draft-{uuid.uuid4().hex}")
        final, _ = self._fs(f"{folder}/v{version.number:08d}.json")
        stream = fs.create(draft)
        stream.write(bytearray(body, "utf-8"))
        stream.close()
        # A rename that never overwrites: of two writers one fails, and takes its draft away.
        context = self.spark.sparkContext
        hadoop = context._jvm.org.apache.hadoop.fs
        option = getattr(hadoop, "Options$Rename")
        never = context._gateway.new_array(option, 1)
        never[0] = option.NONE
        try:
            hadoop.FileContext.getFileContext(fs.getUri(), context._jsc.hadoopConfiguration()).rename(draft, final, never)
        except Exception as error:
            fs.delete(draft, False)
            raise RuntimeError(f"{self.root(spec, layer)}: version {version.number} was committed by another run") from error

    def read(
        self,
        spec: TableSpec,
        layer: str,
        part: str | None = None,
        buckets: Sequence[int] | None = None,
        number: int | None = None,
    ) -> DataFrame | None:
        """A version's rows, or ``None`` before the first commit.

        ``part`` and ``buckets`` choose whole directories, so the rest is not even listed.
        """
        version = self.version(spec, layer, number)
        if version is None:
            return None
        wanted = None if buckets is None or version.buckets != spec.buckets else set(buckets)
        paths = [
            p.path
            for p in version.pieces
            if (part is None or p.part == part) and (wanted is None or p.bucket in wanted)
        ]
        if not paths:
            return self.spark.createDataFrame([], version.schema)
        data = f"{self.root(spec, layer)}/data"
        return (
            self.spark.read.schema(version.schema)
            .option("basePath", data)
            .parquet(*[f"{data}/{p}" for p in paths])
            .select(*[F.col(f"`{n}`") for n in version.schema.names])
        )

    def commit(
        self,
        spec: TableSpec,
        layer: str,
        df: DataFrame,
        keep: Callable[[Piece], bool] = lambda piece: False,
        part: Column | None = None,
        notes: dict | None = None,
        count: bool = True,
        full: bool = False,
    ) -> int | None:
        """Write ``df`` as the next version; with ``count`` return the rows written.

        ``keep`` selects the directories of the previous version that stay.  With
        several buckets the rows are rebalanced by bucket: adaptive execution then
        splits a bucket that is too large for one task and merges tiny ones.  The
        version's notes say which version last changed rows (``data``), and which
        last held a complete snapshot (``full``); schema changes leave both.
        """
        before = self.version(spec, layer)
        if before is not None and before.buckets != spec.buckets and any(map(keep, before.pieces)):
            raise ValueError(f"{spec.label}: bucket count changed; run a full load first")
        number = 1 if before is None else before.number + 1
        segment = f"{number:08d}-{uuid.uuid4().hex[:8]}"
        out = df.withColumns({"_part": F.lit(ALL) if part is None else part, "_bucket": bucket_of(spec)})
        if bucketed(spec):
            out = out.hint("rebalance", F.col("_part"), F.col("_bucket"))
        data = f"{self.root(spec, layer)}/data"
        writer = out.write.mode("errorifexists").partitionBy("_part", "_bucket").option("compression", "snappy")
        if spec.rows_per_file:
            writer = writer.option("maxRecordsPerFile", spec.rows_per_file)
        writer.parquet(f"{data}/_seg={segment}")
        written = [
            Piece(segment, p.split("=", 1)[1], int(b.split("=", 1)[1]))
            for p in self._names(f"{data}/_seg={segment}")
            if p.startswith("_part=")
            for b in self._names(f"{data}/_seg={segment}/{p}")
            if b.startswith("_bucket=")
        ]
        kept = [p for p in before.pieces if keep(p)] if before is not None else []
        carried = {**(before.notes if before is not None else {}), **(notes or {}), "data": number}
        if full:
            carried["full"] = number
        self._publish(
            spec, layer, Version(number, T.StructType(df.schema.fields), (*kept, *written), spec.buckets, carried)
        )
        if not count:
            return None
        if not written:
            return 0
        # Counting a column-free scan reads parquet footers only.
        return self.spark.read.parquet(f"{data}/_seg={segment}").count()

    def evolve(self, spec: TableSpec, layer: str, schema: T.StructType) -> None:
        """Change the schema alone; files that lack a column read as NULL."""
        before = self.version(spec, layer)
        self._publish(
            spec, layer, Version(before.number + 1, schema, before.pieces, before.buckets, before.notes)
        )

    def annotate(self, spec: TableSpec, layer: str, notes: dict) -> None:
        """Change the notes alone."""
        before = self.version(spec, layer)
        if any(before.notes.get(k) != v for k, v in notes.items()):
            merged = {**before.notes, **notes}
            self._publish(spec, layer, Version(before.number + 1, before.schema, before.pieces, before.buckets, merged))

    def expire(self, spec: TableSpec, layer: str, keep_versions: int = 2) -> int:
        """Drop manifests but the newest ``keep_versions`` and the directories only they used.

        Segments of failed writes go too, once a later version exists: a segment is
        named after the version it was written for.
        """
        folder, data = f"{self.root(spec, layer)}/versions", f"{self.root(spec, layer)}/data"
        known = sorted(int(n[1:-5]) for n in self._names(folder) if n.startswith("v") and n.endswith(".json"))
        retained = known[-keep_versions:]
        if not retained:
            return 0
        needed = {p.path for n in retained for p in self.version(spec, layer, n).pieces}
        stale = {
            p.path for n in known[:-keep_versions] for p in self.version(spec, layer, n).pieces
        } - needed
        for n in known[:-keep_versions]:
            target, fs = self._fs(f"{folder}/v{n:08d}.json")
            fs.delete(target, False)
        for path in stale:
            target, fs = self._fs(f"{data}/{path}")
            fs.delete(target, True)
        used = {p.split("/", 1)[0] for p in needed}
        for name in self._names(data):
            number = name.removeprefix("_seg=").split("-", 1)[0]
            if name not in used and number.isdigit() and int(number) < known[-1]:
                target, fs = self._fs(f"{data}/{name}")
                fs.delete(target, True)
        return len(stale)
