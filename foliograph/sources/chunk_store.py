"""Named, isolated chunk collections: Parquet folders under numbered snapshots.

A change writes a folder of its own and then one small file,
``log/<number>.json``, that lists the folders of the new snapshot.  Readers
take the highest number, so they see a change whole or not at all; folders they
are reading stay until ``clean``.  Two writers cannot take the same number: the
one that comes later looks at what was stored meanwhile and tries the next one.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from foliograph.operators.lookup import KeyedFiles, key_ranges
from foliograph.session import scratch_path
from foliograph.sources.files import names, remove, write_once

# New ids up to which an append broadcasts them instead of shuffling all
# stored ids.
BROADCAST_IDS = 500_000
# Snapshots an append may be overtaken by before it gives up.
ATTEMPTS = 20


class ChunkStore:
    """One collection under a root folder on shared storage."""

    def __init__(self, spark: SparkSession, root: str, collection: str = "papers_chunks") -> None:
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", collection):
            raise ValueError(f"not a collection name: {collection!r}")
        self.spark = spark
        self.collection = collection
        self.path = f"{root.rstrip('/')}/{collection}"

    def snapshot(self, number: int | None = None) -> dict | None:
        """The latest snapshot (or the one of this number), None for a collection never written."""
        if number is None:
            found = [int(n[:-5]) for n in names(self.spark, f"{self.path}/log") if re.fullmatch(r"\d+\.json", n)]
            if not found:
                return None
            number = max(found)
        text = self.spark.read.text(f"{self.path}/log/{number:012d}.json", wholetext=True).first()[0]
        return {"number": number, **json.loads(text)}

    def _rows(self, snapshot: dict) -> DataFrame:
        return self._folders(f["data"] for f in snapshot["folders"])

    def _folders(self, folders) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.path}/{f}" for f in folders])

    def read(self, number: int | None = None) -> DataFrame:
        """The chunks of the latest snapshot, or of an earlier one."""
        held = self.snapshot(number)
        if held is None:
            raise ValueError(f"collection {self.collection!r} has not been built at {self.path}")
        return self._rows(held)

    def size(self) -> int:
        held = self.snapshot()
        return 0 if held is None else self._rows(held).count()

    def is_empty(self) -> bool:
        held = self.snapshot()
        return held is None or self._rows(held).isEmpty()

    def backend(self) -> str | None:
        """The back end that made the stored vectors, None where there are none."""
        held = self.snapshot()
        return None if held is None else _backend(self._rows(held).schema)

    def replace(self, chunks: DataFrame) -> None:
        """Make ``chunks`` the whole content; until it is written the old content stays."""
        folder = self._write(chunks)
        for _ in range(ATTEMPTS):
            if self._commit(self.snapshot(), [folder], {}):
                return
        raise RuntimeError(f"collection {self.collection!r} keeps changing")

    def append(
        self,
        chunks: DataFrame,
        prepare: Callable[[DataFrame], DataFrame] = lambda new: new,
        source: str | None = None,
        batch: int | None = None,
    ) -> None:
        """Add the chunks whose ids are not stored yet; repeating an append changes nothing.

        ``chunks`` are computed once.  ``prepare`` is applied to the unseen
        ones, to add their vectors.  A ``batch`` of a ``source`` (a stream's
        micro-batches, in order) that was added before is not looked at.
        """
        held = self.snapshot()
        if _applied(held, source, batch):
            return
        path = scratch_path(self.spark, "append")
        chunks.write.parquet(path)
        try:
            self._append(self.spark.read.parquet(path), held, prepare, source, batch)
        finally:
            remove(self.spark, path)

    def _append(self, given: DataFrame, held: dict | None, prepare, source: str | None, batch: int | None) -> None:
        applied = {source: batch} if source is not None and batch is not None else {}
        folder = base = None
        for _ in range(ATTEMPTS):
            if folder is None or not _extends(held, base):
                new = _one_per_id(given) if held is None else only_new(given, self._rows(held))
                folder = self._write(prepare(new), held)
            elif held["folders"][len(base["folders"]) :]:
                # Another writer came first: what it stored leaves our folder.
                added = self._folders(f["data"] for f in held["folders"][len(base["folders"]) :])
                folder = self._write(only_new(self._folders([folder["data"]]), added), held)
            folders = held["folders"] if held else []
            if not folders or not self._folders([folder["data"]]).isEmpty():
                folders = [*folders, folder]
            elif not applied:
                return
            if self._commit(held, folders, applied, keep=True):
                return
            base, held = held or {"folders": []}, self.snapshot()
            if _applied(held, source, batch):
                return
        raise RuntimeError(f"collection {self.collection!r} keeps changing")

    def organise(self) -> None:
        """Store all chunks sorted by id, with the ids each file holds, so that few files are read for some ids."""
        held = self.snapshot()
        if held is None:
            raise ValueError(f"collection {self.collection!r} has not been built at {self.path}")
        name = uuid.uuid4().hex
        rows = self._rows(held).repartitionByRange("chunk_id").sortWithinPartitions("chunk_id")
        rows.write.option("parquet.bloom.filter.enabled#chunk_id", "true").parquet(f"{self.path}/data/{name}")
        ranges = key_ranges(self._folders([f"data/{name}"]), "chunk_id")
        ranges.coalesce(1).write.parquet(f"{self.path}/keys/{name}")
        if not self._commit(held, [{"data": f"data/{name}", "keys": f"keys/{name}"}], {}, keep=True):
            raise RuntimeError(f"collection {self.collection!r} was changed while it was organised")

    def keyed_files(self) -> KeyedFiles | None:
        """Where ids are to be found, if the whole collection is organised."""
        held = self.snapshot()
        if held is None or not held["folders"] or any("keys" not in f for f in held["folders"]):
            return None
        ranges = self.spark.read.parquet(*[f"{self.path}/{f['keys']}" for f in held["folders"]])
        return KeyedFiles(self._rows(held), "chunk_id", ranges)

    def clean(self, keep: int = 1) -> None:
        """Delete folders that none of the last ``keep`` snapshots reads; nobody may be reading or writing them."""
        if keep < 1:
            raise ValueError("at least one snapshot stays")
        last = self.snapshot()
        if last is None:
            return
        numbers = sorted(int(n[:-5]) for n in names(self.spark, f"{self.path}/log") if re.fullmatch(r"\d+\.json", n))
        used = {p for n in numbers[-keep:] for f in self.snapshot(n)["folders"] for p in f.values()}
        for number in numbers[:-keep]:
            remove(self.spark, f"{self.path}/log/{number:012d}.json")
        for kind in ("data", "keys"):
            for name in names(self.spark, f"{self.path}/{kind}"):
                if f"{kind}/{name}" not in used:
                    remove(self.spark, f"{self.path}/{kind}/{name}")

    def _write(self, rows: DataFrame, held: dict | None = None) -> dict:
        if held is not None and held["folders"]:
            stored, own = _backend(self._rows(held).schema), _backend(rows.schema)
            if stored != own:
                raise ValueError(f"collection {self.collection!r} holds {stored} vectors, not {own} ones")
        name = f"data/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{name}")
        return {"data": name}

    def _commit(self, held: dict | None, folders: list[dict], applied: dict, keep: bool = False) -> bool:
        """Make these folders the snapshot after ``held``; False if there is another one already."""
        number = held["number"] + 1 if held else 1
        before = held["applied"] if held and keep else {}
        text = json.dumps({"folders": folders, "applied": {**before, **applied}})
        return write_once(self.spark, f"{self.path}/log/{number:012d}.json", text)


def _backend(schema: T.StructType) -> str | None:
    if "embedding" not in schema.names:
        return None
    return "hashed" if isinstance(schema["embedding"].dataType, T.StructType) else "external"


def _applied(held: dict | None, source: str | None, batch: int | None) -> bool:
    return held is not None and source is not None and batch is not None and batch <= held["applied"].get(source, -1)


def _extends(held: dict | None, base: dict) -> bool:
    """Whether ``held`` has all folders of ``base`` and perhaps further ones."""
    return held is not None and held["folders"][: len(base["folders"])] == base["folders"]


def only_new(chunks: DataFrame, stored: DataFrame, broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """Chunks whose id is not among the stored ones; only ids are compared.

    The new ids are counted first, so ``chunks`` should be a stored table.  A
    few of them go to the scan of the stored ids, which then needs no shuffle;
    with more, both sides are joined by id.
    """
    ids = chunks.select("chunk_id")
    known = stored.select("chunk_id")
    if ids.count() <= broadcast_ids:
        known = F.broadcast(known.join(F.broadcast(ids), "chunk_id", "left_semi").distinct())
    return _one_per_id(chunks.join(known, "chunk_id", "left_anti").select(*chunks.columns))


def _one_per_id(chunks: DataFrame) -> DataFrame:
    """Of chunks with one id the first by their other columns in column order.

    Only ids that occur twice are shuffled with their texts.
    """
    twice = chunks.groupBy("chunk_id").agg(F.count("*").alias("n")).filter("n > 1").select("chunk_id")
    if twice.isEmpty():
        return chunks
    others = [c for c in chunks.columns if c != "chunk_id"]
    first = (
        chunks.join(twice, "chunk_id", "left_semi")
        .groupBy("chunk_id").agg(F.min(F.struct(*others)).alias("first"))
        .select("chunk_id", "first.*").select(*chunks.columns)
    )
    return chunks.join(twice, "chunk_id", "left_anti").unionByName(first)
