"""Generations behind an alias (SNK-1..9).

* A *generation* is an immutable Parquet table ``<alias>_<yyyyMMddHHmmssSSS><n>``
  in the store database, located under the shared folder
  (``spark.checkpoint.dir``); its alias, declared mapping and analyzer are frozen
  in table properties at creation. An alias owns the tables that carry its name in
  that property -- never tables whose name merely starts like it.
* What is live is said by the alias's *version log* (``versions``): numbered records, each committed by
  create-if-absent. The *alias* itself is a catalog view over the live generation, brought in line with
  the newest record after every commit (one ``CREATE OR REPLACE VIEW``, atomic for readers).
* Upserts and deletes after publish -- populate included -- go to the generation's
  change log ``(id, _seq, _deleted, fields...)``, one folder per batch. A batch is written and checked aside, then
  committed as a record, then renamed into the log; a batch of the same name that is there goes
  afterwards, so replays change nothing. Sequences are microseconds issued by the store, or event times in the
  same unit. The alias keeps generation rows whose id is not in the log (anti join, the
  log's ids broadcast while small) and adds the latest log row per changed id
  (``max_by`` on ``_seq``) unless it is a tombstone. ``compact`` folds the log into
  a fresh generation without the source.
* Writers and publishers may run at the same time. A publish is a record on top of all batches: those committed since
  the new generation's read began are carried into its log first, and a batch that still slips in
  makes the publish look again. A writer that finds its generation replaced writes its batch anew for the
  new one. A publish whose starting point is no longer live is refused (``PublishConflict``).
* Documents that the mapping rejects are told from the others in the writing pass and kept, all of
  them, in the alias's rejects.

Everything that touches rows is a Spark job; the driver only issues catalog
DDL and reads catalog metadata.
"""

from __future__ import annotations

import contextlib
import datetime as _dt
import itertools
import json
import time
import uuid
from collections.abc import Callable, Mapping
from functools import reduce
from typing import NamedTuple
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docforge.operators.manifest import Manifest, created
from docforge.operators.versions import VersionLog
from docforge.session import shared_root
from docforge.sources.tables import small_frame
from docforge.spec import AnalyzerSpec, FieldSpec

_COUNTER = itertools.count()
PROP_ALIAS = "docforge.alias"
PROP_GENERATION = "docforge.generation"
PROP_MAPPING = "docforge.mapping"
PROP_ANALYZER = "docforge.analyzer"
PROP_DYNAMIC = "docforge.dynamic"
PROP_LOGGED = "docforge.logged"
FIELD_LIMIT = "index.mapping.total_fields.limit"
#: Times a writer starts anew because its generation was replaced meanwhile.
ATTEMPTS = 20


class PublishConflict(RuntimeError):
    """The alias is no longer what this publish or batch started from."""


class RejectedDocuments(RuntimeError):
    """Documents that the mapping rejects; ``load`` names them in ``DocumentStore.rejects``."""

    def __init__(self, message: str, count: int, load: str) -> None:
        super().__init__(message)
        self.count, self.load = count, load


class Head(NamedTuple):
    """The newest record of an alias: its number, the live generation, the highest sequence so far."""

    number: int
    generation: str | None
    seq: int


class Applied(NamedTuple):
    """What a batch wrote: its name, documents, tombstones, rejected documents."""

    batch: str
    upserts: int
    deletes: int
    rejected: int


class DocumentStore:
    def __init__(self, spark: SparkSession, database: str = "docforge", root: str | None = None, recorder=None):
        """``recorder`` (a ``calls.CallRecorder``) gets a row for every action on an index."""
        self.spark = spark
        self.recorder = recorder
        self.root = (root or f"{shared_root(spark)}/store").rstrip("/")
        self.db = database
        self.manifest = Manifest(spark, self.root, database)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.db} LOCATION '{self.root}/{self.db}.db'")

    # ---- naming and catalog -------------------------------------------------
    def new_generation_name(self, alias: str) -> str:
        stamp = _dt.datetime.now(_dt.UTC).strftime("%Y%m%d%H%M%S%f")[:-3]
        return f"{alias}_{stamp}{next(_COUNTER):04d}"

    def qualified(self, name: str) -> str:
        return f"{self.db}.`{name}`"

    def path_of(self, generation: str) -> str:
        return f"{self.root}/generations/{generation}"

    def _tables(self) -> list:
        return self.spark.catalog.listTables(self.db)

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.db}.{name}")

    def is_view(self, name: str) -> bool:
        return self.exists(name) and self.spark.catalog.getTable(f"{self.db}.{name}").tableType == "VIEW"

    def properties(self, name: str) -> dict[str, str]:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.qualified(name)}").collect()
        return {r["key"]: r["value"] for r in rows}

    def _versions(self, alias: str) -> VersionLog:
        return VersionLog(self.spark, f"{self.root}/versions/{self.db}/{alias}")

    def head(self, alias: str) -> Head:
        """The newest record. If it is a batch that isn't in the log yet (its writer died) it is put there, so whoever commits the next
        record leaves none behind."""
        log = self._versions(alias)
        number, record = log.head()
        if record is None:
            return Head(0, None, 0)
        self._place(alias, number, record)
        return Head(number, record["generation"], record["seq"])

    def live_generation(self, alias: str) -> str | None:
        return self.head(alias).generation

    def generations(self, alias: str) -> list[str]:
        """The tables that belong to the alias (by their property, not their name), oldest first."""
        return sorted(t.name for t in self._tables()
                      if t.tableType != "VIEW" and t.name.startswith(f"{alias}_")
                      and self.properties(t.name).get(PROP_ALIAS) == alias)

    def declared(self, generation: str) -> tuple[dict[str, FieldSpec], AnalyzerSpec, bool]:
        """Mapping, analyzer and strictness frozen in a generation."""
        props = self.properties(generation)
        mapping = {k: FieldSpec(kind, keyword) for k, (kind, keyword) in json.loads(props.get(PROP_MAPPING, "{}")).items()}
        analyzer = json.loads(props.get(PROP_ANALYZER, "{}"))
        return (mapping, AnalyzerSpec(analyzer.get("language"), analyzer.get("ascii_folding", True)),
                props.get(PROP_DYNAMIC) == "strict")

    def declared_settings(self, generation: str) -> dict[str, str]:
        """Settings declared for a generation."""
        records = [r for _, r in self.manifest._log(generation).after(0)]
        return next((json.loads(r["settings"]) for r in records if r.get("settings")), {})

    # ---- create / write / publish ------------------------------------------
    def create_generation(self, alias: str, schema: T.StructType, mapping: Mapping[str, FieldSpec] | None = None,
                          analyzer: AnalyzerSpec | None = None, strict: bool = True,
                          settings: Mapping[str, object] | None = None) -> str:
        """SNK-4: new empty generation with the mapping frozen in its properties, and ``settings`` (flat keys, limits among them) in the
        manifest. A mapping beyond its own ``index.mapping.total_fields.limit`` is refused."""
        mapping, settings = dict(mapping or {}), {k: str(v) for k, v in (settings or {}).items()}
        limit, fields = int(settings.get(FIELD_LIMIT, 0)), len(mapping) + sum(v.has_keyword for v in mapping.values())
        if limit and fields > limit:
            raise ValueError(f"{fields} fields in the mapping of {alias}, limit {limit}")
        name = self.new_generation_name(alias)
        props = {
            PROP_ALIAS: alias,
            PROP_MAPPING: json.dumps({k: [v.type, v.has_keyword] for k, v in mapping.items()}),
            PROP_ANALYZER: json.dumps({"language": (analyzer or AnalyzerSpec()).language,
                                       "ascii_folding": (analyzer or AnalyzerSpec()).ascii_folding}),
            PROP_DYNAMIC: "strict" if strict else "true",
        }
        prop_sql = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in props.items())
        self.spark.sql(f"CREATE TABLE {self.qualified(name)} ({_ddl(schema)}) USING parquet "
                       f"LOCATION '{self.path_of(name)}' TBLPROPERTIES ({prop_sql})")
        id_type = schema["id"].dataType.simpleString() if "id" in schema.names else "string"
        self.manifest.enter(name, owner=alias, **created(mapping, analyzer or AnalyzerSpec(), strict, settings, id_type))
        return name

    def adopt(self, name: str, settings: Mapping[str, object] | None = None) -> None:
        """Take a concrete table that was made elsewhere into the manifest, its documents counted once. Such a table has no owner; adopt it
        again after it has changed."""
        table = self.spark.table(self.qualified(name))
        id_type = table.schema["id"].dataType.simpleString() if "id" in table.columns else "string"
        docs = table.count()
        self.manifest.drop(name)
        self.manifest.enter(name, owner=None, docs=docs,
                            **created({}, AnalyzerSpec(), False, {k: str(v) for k, v in (settings or {}).items()}, id_type))

    def fill(self, generation: str, documents: DataFrame, batch_size: int | None = None,
             unique_ids: bool = False, order_by: str | None = None, on_reject: str = "ignore") -> int:
        """SNK-1: write documents into a generation; returns the documents written.

        A generation holds one document per id. With ``order_by`` the row that is
        last in that column stays (``max_by``, combined per task, so a hot id never
        reaches one reducer as raw rows). Without it repeated ids are an error: a
        table has no row order that survives splits, so "the later row" would be
        chance. The check reads the ids just written, not the source again;
        ``unique_ids=True`` skips it. ``batch_size`` bounds the rows per output
        file; the write is one job, all-or-nothing at commit.

        ``on_reject`` (SNK-3): ``ignore`` writes without a look at the mapping; otherwise the same pass deals the rows into
        accepted and rejected ones, and the rejected ones are kept in the alias's rejects under the
        generation's name. ``fail`` then raises, ``accept`` keeps the accepted ones."""
        columns = self.spark.table(self.qualified(generation)).columns
        out = documents.select(*[F.col(f"`{c}`") for c in columns])
        if order_by is not None:
            out = last_per_id(documents, columns, order_by)
        mapping, _, strict = self.declared(generation) if on_reject != "ignore" else ({}, None, False)
        staged = self._staged()
        counts = self._deal(out, staged, mapping, strict, batch_size)
        try:
            if counts["rejected"]:
                load = self._keep_rejects(staged, self.properties(generation)[PROP_ALIAS], generation)
                if on_reject == "fail":
                    raise self._rejection(self.properties(generation)[PROP_ALIAS], load, counts["rejected"])
            self._move_files(f"{staged}/_rejected=false", self.path_of(generation))
        finally:
            self._delete_path(staged)
        self.spark.catalog.refreshTable(f"{self.db}.{generation}")
        if order_by is None and not unique_ids:
            refuse_repeated_ids(self.spark.table(self.qualified(generation)))
        self.manifest.enter(generation, kind="filled", docs=counts["accepted"])
        return counts["accepted"]

    # ---- writing aside ------------------------------------------------------
    def _staged(self) -> str:
        return f"{self.root}/staging/{uuid.uuid4().hex}"

    def _deal(self, rows: DataFrame, folder: str, mapping: Mapping[str, FieldSpec], strict: bool, batch_size: int | None = None,
              parts: tuple[str, ...] = ()) -> dict[str, int]:
        """Write ``rows`` once: accepted ones under ``_rejected=false`` of ``folder`` (below the folders of ``parts``), those the mapping
        rejects, with type and reason, under ``_rejected=true``. Tombstones are never rejected. Returns what was counted on the way."""
        from docforge.operators.validate import classify_rows
        log_columns = [c for c in ("_seq", "_deleted", *parts) if c in rows.columns]
        observation = Observation(f"dealt_{uuid.uuid4().hex}")
        deleted = F.col("_deleted") if "_deleted" in rows.columns else F.lit(False)
        bad = F.lit(False)
        if mapping:
            rows = classify_rows(rows, mapping, strict, ignore=tuple(log_columns))
            bad = F.col("reject_type").isNotNull() & ~deleted
        counted = rows.withColumn("_rejected", bad).observe(
            observation, F.count_if(~F.col("_rejected")).alias("accepted"), F.count_if("_rejected").alias("rejected"),
            F.count_if(deleted).alias("deletes"), (F.max("_seq") if "_seq" in rows.columns else F.lit(None).cast("long")).alias("seq"))
        options = {"maxRecordsPerFile": int(batch_size)} if batch_size else {}
        if mapping or parts:
            counted.write.options(**options).partitionBy(*parts, "_rejected").parquet(folder)
        else:
            counted.drop("_rejected").write.options(**options).parquet(f"{folder}/_rejected=false")
        got = observation.get
        return {"accepted": int(got["accepted"]), "rejected": int(got["rejected"]), "deletes": int(got["deletes"]), "seq": got["seq"]}

    def _move_files(self, source: str, target: str) -> None:
        """Put the files of a finished folder into ``target``: one rename if that is empty, else one a file."""
        if not self._path_exists(source):
            return
        fs, path = self._fs(target)
        source_path = self._fs(source)[1]
        if not fs.exists(path) or not fs.listStatus(path):
            if fs.exists(path):
                fs.delete(path, True)
            self._rename(source, target)
            return
        hadoop_path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for status in fs.listStatus(source_path):
            if not status.getPath().getName().startswith("_") and not fs.rename(status.getPath(), hadoop_path(path, status.getPath().getName())):
                raise OSError(f"{status.getPath().toString()} could not be moved to {target}")

    # ---- rejected documents -------------------------------------------------
    def _rejects_path(self, alias: str, load: str) -> str:
        return f"{self.root}/rejects/{self.db}/{alias}/{load}"

    def _keep_rejects(self, staged: str, alias: str, load: str, below: str = "") -> str:
        self._delete_path(self._rejects_path(alias, load))
        self._move_files(f"{staged}{below}/_rejected=true", self._rejects_path(alias, load))
        return load

    def _rejection(self, alias: str, load: str, count: int) -> RejectedDocuments:
        first = self.rejects(alias, load).select("id", "reject_type", "reason").orderBy("id").first()
        return RejectedDocuments(f'rejected document "{first[0]}": {{"type": "{first[1]}", "reason": "{first[2]}"}} ({count} rejected)',
                                 count, load)

    def rejects(self, alias: str, load: str | None = None) -> DataFrame:
        """SNK-3: every rejected document of a load (a generation's or a batch's name; the latest one) with ``reject_type`` and
        ``reason``. No rejects: an empty table of id, type and reason."""
        if load is None:
            fs, path = self._fs(f"{self.root}/rejects/{self.db}/{alias}")
            found = [(s.getModificationTime(), s.getPath().getName()) for s in fs.listStatus(path)] if fs.exists(path) else []
            load = max(found)[1] if found else None
        if load is None or not self._path_exists(self._rejects_path(alias, load)):
            return self.spark.createDataFrame([], "id string, reject_type string, reason string")
        return self.spark.read.parquet(self._rejects_path(alias, load))

    # ---- publish ------------------------------------------------------------
    def publish(self, alias: str, generation: str, since: Head | None = None) -> None:
        """SNK-5: make ``generation`` live by one record, then swap the alias view.

        ``since``: the head the generation was made from. If another generation has been published meanwhile the
        publish is refused; batches committed since then are carried into the generation's log first, and a
        batch that lands during that makes it look again. Without it the generation goes live as it is
        (a rollback to a kept one), on top of whatever was."""
        self.guard(alias)
        log = self._versions(alias)
        carried = since.number if since else 0
        for _ in range(ATTEMPTS * 50):
            head = self.head(alias)
            if since is not None:
                if head.generation != since.generation:
                    raise PublishConflict(f"{alias} went from {since.generation} to {head.generation} while {generation} was made")
                for number, record in log.after(carried):
                    if record["kind"] == "batch":
                        self._carry(alias, number, record, generation)
                carried = head.number
            record = {"kind": "publish", "generation": generation, "seq": head.seq}
            if log.commit(head.number + 1, record):
                self._show(alias)
                log.trim(head.number + 1)
                return
        raise PublishConflict(f"{alias} never stood still long enough to publish {generation}")

    def _carry(self, alias: str, number: int, record: dict, generation: str) -> None:
        """A committed batch of the old generation, copied into the new one's log with the new columns."""
        source = self._batch_path(record["generation"], number, record["batch"])
        if not self._path_exists(source):
            return  # empty, or replaced by a later batch of its name
        rows = self.spark.read.parquet(source)
        table = self.spark.table(self.qualified(generation)).schema
        here = {f.name for f in rows.schema.fields}
        fields = [(F.col(f"`{f.name}`") if f.name in here else F.lit(None)).cast(f.dataType).alias(f.name) for f in table.fields]
        mapping, _, strict = self.declared(generation)
        staged = self._staged()
        try:
            counts = self._deal(rows.select(*fields, "_seq", "_deleted"), staged, mapping, strict)
            if counts["rejected"]:
                raise self._rejection(alias, self._keep_rejects(staged, alias, record["batch"]), counts["rejected"])
            target = self._batch_path(generation, number, record["batch"])
            self._delete_path(target)
            self._move_files(f"{staged}/_rejected=false", target)
            self._drop_older(generation, number, record["batch"])
        finally:
            self._delete_path(staged)

    def _show(self, alias: str) -> None:
        """Bring the alias view in line with the newest record."""
        while True:
            generation = self.head(alias).generation
            if generation is None:
                return
            logged = str(self._has_log(generation)).lower()
            shown = self.properties(alias) if self.is_view(alias) else {}
            if (shown.get(PROP_GENERATION), shown.get(PROP_LOGGED)) != (generation, logged):
                self.spark.sql(
                    f"CREATE OR REPLACE VIEW {self.qualified(alias)} TBLPROPERTIES ({_quoted(PROP_GENERATION)} = {_quoted(generation)}, "
                    f"{_quoted(PROP_LOGGED)} = {_quoted(logged)}) AS {self._live_sql(generation)}")
            if self._versions(alias).head()[1]["generation"] == generation:  # nobody published in between
                return

    def guard(self, alias: str) -> None:
        """An alias never takes the name of a concrete table."""
        if self.exists(alias) and not self.is_view(alias):
            raise RuntimeError(f"{alias} is a concrete table, not an alias")

    def drop_generation(self, generation: str) -> None:
        if self.exists(generation):
            self.spark.sql(f"DROP TABLE {self.qualified(generation)}")
        for path in (self.path_of(generation), self.log_path(generation), self.terms_path(generation)):
            self._delete_path(path)
        self.manifest.drop(generation)

    def terms_path(self, generation: str) -> str:
        """Folder of the generation's term index (dropped with the generation)."""
        return self.path_of(f"{generation}__terms")

    def terms(self, alias: str) -> DataFrame:
        """Terms of the alias's documents: the generation's term index without the
        ids in the change log, plus the analysed latest log row of each of them."""
        generation = self.live_generation(alias)
        if generation is None:
            raise LookupError(f"no live generation behind {alias}")
        stored = self.spark.read.parquet(self.terms_path(generation))
        if not self._has_log(generation):
            return stored
        from docforge.operators.analysis import analyzed_fields
        mapping, analyzer, _ = self.declared(generation)
        log = self.spark.read.parquet(self.log_path(generation))
        changed = self.spark.sql(self._changed_sql(generation))
        fresh = analyzed_fields(changed, "id", mapping, analyzer)
        return (stored.join(log.select("id").distinct(), "id", "left_anti")
                .unionByName(fresh.select(*stored.columns)))

    def read(self, alias: str) -> DataFrame:
        self._show(alias)
        return self.spark.table(self.qualified(alias))

    def _recorded(self, operation: str, index: str):
        """The recorder's row of an action, or a row that nobody reads."""
        return self.recorder.call(operation, index) if self.recorder else contextlib.nullcontext({})

    # ---- lifecycle ----------------------------------------------------------
    def rebuild(self, alias: str, documents: Callable[[], DataFrame] | DataFrame,
                mapping: Mapping[str, FieldSpec] | None = None, analyzer: AnalyzerSpec | None = None,
                strict: bool = True, keep_old: bool = False,
                validate: Callable[[DataFrame], None] | None = None,
                analyze: Callable[[DataFrame], DataFrame | Mapping[str, DataFrame]] | None = None, order_by: str | None = None,
                on_reject: str = "fail", accept: Callable[[DataFrame], None] | None = None,
                settings: Mapping[str, object] | None = None) -> str:
        """SNK-6: build and fill first, check, publish last. Any failure, the
        publish included, drops the half-built generation and leaves the alias
        untouched. Afterwards the generation the alias pointed at goes, unless
        ``keep_old``; kept or unpublished generations stay until ``delete``.

        Changes applied to the alias while this runs are carried over (see :meth:`publish`); those before are the
        source's business. If another rebuild publishes meanwhile, this one fails.

        With a ``mapping`` every document is checked against it in the writing pass (SNK-3); rejected ones fail the rebuild,
        or stay out of it with ``on_reject="accept"``, and are kept in ``rejects``. ``order_by``: see :meth:`fill`.

        ``validate`` sees the documents before, ``accept`` the written ones before they are published; both refuse by raising.
        ``analyze`` turns the written documents into their term table, whole or field by field; it is
        written as the generation's term index before the publish, reading
        the generation's own files (the source is not recomputed)."""
        self.guard(alias)
        since = self.head(alias)
        generation = None
        try:
            docs = documents() if callable(documents) else documents
            generation = self.create_generation(alias, docs.schema, mapping, analyzer, strict, settings)
            if validate is not None:
                validate(docs)
            with self._recorded("bulk", alias) as call:
                call["ops"] = self.fill(generation, docs, order_by=order_by, on_reject=on_reject if mapping else "ignore")
            written = self.spark.table(self.qualified(generation))
            if analyze is not None:
                from docforge.operators.analysis import write_term_index
                write_term_index(analyze(written), self.terms_path(generation))
            if accept is not None:
                accept(written)
            self.publish(alias, generation, since)
        except BaseException:
            if generation is not None:
                self.drop_generation(generation)
            raise
        if since.generation is not None and not keep_old:
            self.drop_generation(since.generation)
        return generation

    def create(self, alias: str, schema: T.StructType, drop: bool = False, **kw) -> str | None:
        """SNK-7: alias held by a concrete table -> error; the alias exists and no
        ``drop`` -> skip (None); ``drop`` -> publish an empty generation, then delete
        the one the alias pointed at. Unpublished leftovers don't count."""
        self.guard(alias)
        previous = self.live_generation(alias)
        if previous is not None and not drop:
            return None
        with self._recorded("create", alias):
            generation = self.create_generation(alias, schema, **kw)
        try:
            self.publish(alias, generation)  # an emptied index drops what was changed meanwhile, too
        except BaseException:
            self.drop_generation(generation)
            raise
        if previous is not None:
            self.drop_generation(previous)
        return generation

    def populate(self, alias: str, documents: DataFrame, limit: int | None = None, batch_size: int = 250,
                 order_by: str | None = None, on_reject: str = "fail") -> int:
        """SNK-8: upsert documents (first ``limit`` by id, 0/None = all) into the live
        index by id; returns documents sent. They go through the change log with a
        fresh sequence, so a document replaces the one of its id, also a deleted one.
        Repeated ids need ``order_by`` (the last row stays). Missing alias ->
        warning, 0."""
        if self.live_generation(alias) is None:
            import warnings
            warnings.warn(f"no live generation behind {alias}; run create first")
            return 0
        from docforge.operators.documents import apply_limit
        documents = apply_limit(documents, limit)

        def rows(schema: T.StructType, seq: int) -> DataFrame:
            docs = documents if order_by is None else last_per_id(documents, schema.names, order_by)
            return docs.select(*[F.col(f"`{c}`") for c in schema.names], F.lit(seq).alias("_seq"), F.lit(False).alias("_deleted"))

        return self._apply(alias, rows, None, batch_size, single=order_by is None, on_reject=on_reject).upserts

    def populate_batches(self, alias: str, documents: DataFrame, run: str, batches: int = 16, batch_of: Column | None = None,
                         order_by: str | None = None) -> dict[str, int]:
        """SNK-8 with batches that stay: the documents go in as ``batches`` batches by ranges of their id's hash (or ``batch_of``, a whole
        number from 0), each committed alone, in order. A batch with a rejected document stops the run (``RejectedDocuments``; the
        rejects are kept); the batches before it stay visible. ``run`` names the load: given again, finished batches are skipped and only
        the rest is written. One pass over the documents for all batches of a call. Returns counts of batches and documents."""
        self._refuse_missing(alias)
        ledger = VersionLog(self.spark, f"{self.root}/runs/{self.db}/{alias}/{quote(run, safe='')}")
        done = {n - 1 for n in ledger.numbers()}
        number = batch_of if batch_of is not None else F.floor(F.shiftrightunsigned(F.xxhash64("id"), 1) / F.lit(float(1 << 63) / batches))
        generation = self.live_generation(alias)
        shape = self._shape(generation)
        columns = self.spark.table(self.qualified(generation)).columns
        mapping, _, strict = self.declared(generation)
        marked = documents.withColumn("_part", number.cast("int")).where(~F.col("_part").isin(sorted(done)) if done else F.lit(True))
        rows = (last_per_id(marked, [*columns, "_part"], order_by) if order_by else marked).select(
            *[F.col(f"`{c}`") for c in columns], F.lit(self.issue_sequence(alias)).alias("_seq"), F.lit(False).alias("_deleted"), "_part")
        staged = self._staged()
        out = {"written": 0, "skipped": len(done), "documents": 0}
        try:
            self._deal(rows, staged, mapping, strict, parts=("_part",))
            if order_by is None and self._path_exists(staged) and self._folders(staged):
                refuse_repeated_ids(self.spark.read.parquet(staged))
            present = {int(n.split("=")[1]) for n in self._folders(staged) if n.startswith("_part=")}
            for k in sorted(present if batch_of is not None else set(range(batches)) - done):
                name, below = f"{run}-{k}", f"/_part={k}"
                if self._path_exists(f"{staged}{below}/_rejected=true"):
                    load = self._keep_rejects(staged, alias, quote(name, safe="-_"), below)
                    raise self._rejection(alias, load, self.rejects(alias, load).count())
                counts = {"accepted": 0, "deletes": 0, "rejected": 0, "seq": None}
                folder = f"{staged}{below}/_rejected=false"
                if self._path_exists(folder):
                    found = self.spark.read.parquet(folder).agg(F.count(F.lit(1)), F.max("_seq")).first()
                    counts |= {"accepted": found[0], "seq": found[1]}
                if not self._commit_batch(alias, self.head(alias), folder, name, counts, like=shape):
                    raise PublishConflict(f"{alias} has another shape now; run {run} again")
                self._finish(ledger, k, name)
                out["written"] += 1
                out["documents"] += counts["accepted"]
        finally:
            self._delete_path(staged)
        return out

    @staticmethod
    def _finish(ledger: VersionLog, k: int, name: str) -> None:
        """Enter batch ``k`` in the run's ledger (entries are independent of each other)."""
        if k + 1 not in ledger.numbers():
            ledger.enter(k + 1, {"batch": name})

    # ---- change log (after publish) -----------------------------------------
    def log_path(self, generation: str) -> str:
        return self.path_of(f"{generation}__log")

    def _batch_path(self, generation: str, number: int, batch: str) -> str:
        return f"{self.log_path(generation)}/_batch={number:012d}.{quote(batch, safe='-_')}"

    def _folders(self, path: str) -> list[str]:
        fs, hpath = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(hpath) if s.isDirectory()] if fs.exists(hpath) else []

    def _has_log(self, generation: str) -> bool:
        return any(n.startswith("_batch=") for n in self._folders(self.log_path(generation)))

    def issue_sequence(self, alias: str) -> int:
        """A number above every sequence committed so far: the time in microseconds, or one more than the highest, which the
        newest record has. Event times in microseconds are of the same order."""
        now = int(_dt.datetime.now(_dt.UTC).timestamp() * 1_000_000)
        return max(now, self.head(alias).seq + 1)

    def _refuse_missing(self, alias: str) -> None:
        if self.live_generation(alias) is None:
            raise LookupError(f"no live generation behind {alias}")

    def _apply(self, alias: str, rows: Callable[[T.StructType, int], DataFrame], batch: str | None, batch_size: int | None = None,
               single: bool = False, on_reject: str = "fail") -> Applied:
        """Write, check and commit one batch. ``rows(schema, seq)`` gives its log rows for a generation of that schema; it is
        asked again if the generation is replaced meanwhile. ``single``: an id that occurs twice is an error."""
        self._refuse_missing(alias)
        for _ in range(ATTEMPTS):
            head = self.head(alias)
            self._refuse_missing(alias)
            seq = self.issue_sequence(alias)
            name = batch or f"{seq:020d}"
            staged = self._staged()
            try:
                schema = self.spark.table(self.qualified(head.generation)).schema
                mapping, _, strict = self.declared(head.generation)
                with self._recorded("bulk", alias) as call:
                    start = time.perf_counter()
                    counts = self._deal(rows(schema, seq), staged, mapping, strict, batch_size)
                    call["took_ms"] = (time.perf_counter() - start) * 1000
                    call["ops"] = counts["accepted"] + counts["rejected"]
                if mapping:
                    with self._recorded("validate", alias):
                        if counts["rejected"]:
                            load = self._keep_rejects(staged, alias, quote(name, safe="-_"))
                            if on_reject == "fail":
                                raise self._rejection(alias, load, counts["rejected"])
                folder = f"{staged}/_rejected=false"
                if single and counts["accepted"]:
                    refuse_repeated_ids(self.spark.read.parquet(folder))
                if self._commit_batch(alias, head, folder, name, counts):
                    return Applied(name, counts["accepted"] - counts["deletes"], counts["deletes"], counts["rejected"])
            except AnalysisException:
                if self.head(alias).generation == head.generation:
                    raise  # not because the generation went
            finally:
                self._delete_path(staged)
        raise PublishConflict(f"{alias} was replaced {ATTEMPTS} times while a batch was written")

    def _commit_batch(self, alias: str, head: Head, folder: str, name: str, counts: dict, like: tuple | None = None) -> bool:
        """Commit a batch written to ``folder`` on top of ``head`` or of the batches that came meanwhile; False if the generation was
        replaced, or is not of the shape ``like``."""
        log = self._versions(alias)
        number, seq = head.number + 1, head.seq
        generation = head.generation
        if generation is None or like is not None and self._shape(generation) != like:
            return False
        while True:
            record = {"kind": "batch", "generation": generation, "batch": name, "seq": max(seq, counts["seq"] or 0),
                      "rows": counts["accepted"], "staged": folder}
            if log.commit(number, record):
                self._place(alias, number, record)
                self._show(alias)
                return True
            if number not in log.numbers():
                return False  # trimmed: long overtaken
            other = log.read(number)
            if other["kind"] != "batch" and other["generation"] != generation:
                return False
            self._place(alias, number, other)
            number, seq = number + 1, other["seq"]

    def _shape(self, generation: str) -> tuple | None:
        """Columns and mapping of a generation; None if it is gone."""
        if not self.exists(generation):
            return None
        return (tuple(self.spark.table(self.qualified(generation)).dtypes), *map(str, self.declared(generation)))

    def _place(self, alias: str, number: int, record: dict) -> None:
        """Rename a committed batch into the log, if that has not been done; then drop older ones of its name."""
        if record["kind"] != "batch" or not record["rows"] or not self._path_exists(record["staged"]):
            return
        target = self._batch_path(record["generation"], number, record["batch"])
        if not self._path_exists(target):
            self._rename(record["staged"], target)
        self._drop_older(record["generation"], number, record["batch"])

    def _rename(self, source: str, target: str) -> None:
        """Move a folder to a name that is free; fine if another one has just done it."""
        fs, path = self._fs(target)
        fs.mkdirs(path.getParent())
        try:
            moved = fs.rename(self._fs(source)[1], path)
        except Py4JJavaError:
            moved = False
        if not moved and (self._path_exists(source) or not fs.exists(path)):
            raise OSError(f"{source} could not be moved to {target}")

    def _drop_older(self, generation: str, number: int, batch: str) -> None:
        """A batch written again replaces the one of its name."""
        own = quote(batch, safe="-_")
        for folder in self._folders(self.log_path(generation)):
            count, _, name = folder.removeprefix("_batch=").partition(".")
            if name == own and int(count) < number:
                self._delete_path(f"{self.log_path(generation)}/{folder}")

    def _changed_sql(self, generation: str) -> str:
        """The latest log row of every changed id, tombstones left out. On equal
        sequence a tombstone wins, so a flush whose delete and update arrive in
        different batches still ends deleted."""
        rest = [f"`{c}`" for c in self.spark.table(self.qualified(generation)).columns if c != "id"]
        picked = "".join(f", last_row.{c} AS {c}" for c in rest)
        return (f"SELECT id{picked} FROM (SELECT id, "
                f"max_by(struct({', '.join([*rest, '_deleted'])}), struct(_seq, _deleted)) AS last_row "
                f"FROM parquet.`{self.log_path(generation)}` GROUP BY id) WHERE NOT last_row._deleted")

    def _live_sql(self, generation: str) -> str:
        """The alias body. Without a change log: the generation itself. With
        one: generation rows whose id never changed (anti join against the
        log's ids -- broadcast by AQE while the log is small, so the large
        generation is not shuffled) plus, per changed id, the latest log row
        unless it is a tombstone (the aggregate runs over the log only)."""
        base = self.qualified(generation)
        if not self._has_log(generation):
            return f"SELECT * FROM {base}"
        cols = [f"`{c}`" for c in self.spark.table(base).columns]
        kept = ", ".join(f"b.{c}" for c in cols)
        return (f"SELECT {kept} FROM {base} b LEFT ANTI JOIN "
                f"(SELECT DISTINCT id FROM parquet.`{self.log_path(generation)}`) l ON b.id = l.id "
                f"UNION ALL SELECT {', '.join(cols)} FROM ({self._changed_sql(generation)})")

    def apply_changes(self, alias: str, upserts: DataFrame | None, deletes: DataFrame | None,
                      seq_col: str | None = "_seq", batch: str | None = None, on_reject: str = "fail") -> Applied:
        """SNK-1/SNK-2 on the live generation: upserts (full documents) and
        tombstones (ids) with their sequence (``seq_col``; None: one is issued);
        later ``_seq`` wins. ``batch`` names the batch: given again, it replaces what
        was written under that name (a retried micro-batch). Documents are checked
        against the generation's mapping before the alias sees them. Returns the counts written: documents, and ids
        asked to be deleted (known or not)."""
        self._refuse_missing(alias)
        if upserts is None and deletes is None:
            return Applied(batch or "", 0, 0, 0)

        def rows(schema: T.StructType, issued: int) -> DataFrame:
            seq = (F.lit(issued) if seq_col is None else F.col(seq_col)).cast("bigint").alias("_seq")
            parts = []
            if upserts is not None:
                parts.append(upserts.select(*[F.col(f"`{c}`") for c in schema.names], seq, F.lit(False).alias("_deleted")))
            if deletes is not None:
                nulls = [(F.col("id").cast("string") if f.name == "id" else F.lit(None).cast(f.dataType)).alias(f.name)
                         for f in schema.fields]
                parts.append(deletes.select(*nulls, seq, F.lit(True).alias("_deleted")))
            # one job: upserts and tombstones of a batch commit together
            return reduce(DataFrame.unionByName, parts)

        return self._apply(alias, rows, batch, on_reject=on_reject)

    def reindex(self, alias: str, ids: DataFrame, current: DataFrame, batch: str | None = None, order_by: str | None = None) -> Applied:
        """STR-4: bring the changed ``ids`` to their current state -- the source row of
        now, or a tombstone for an id the source no longer has -- under one sequence
        issued now. One left join of the ids with the source, one log row per id: a source that has several rows of
        an id is an error, unless ``order_by`` names the column whose last one counts."""
        def rows(schema: T.StructType, seq: int) -> DataFrame:
            source = current if order_by is None else last_per_id(current, schema.names, order_by)
            found = ids.select("id").distinct().join(source.withColumn("__here", F.lit(True)), "id", "left")
            return found.select(*[F.col(f"`{c}`") for c in schema.names], F.lit(seq).alias("_seq"), F.col("__here").isNull().alias("_deleted"))

        return self._apply(alias, rows, batch, single=order_by is None)

    def compact(self, alias: str, accept: Callable[[DataFrame], None] | None = None) -> str:
        """Fold the change log into a new generation and publish it; the old one goes. Changes that land meanwhile are
        carried into the new one's log."""
        self._refuse_missing(alias)
        old = self.live_generation(alias)
        mapping, analyzer, strict = self.declared(old)
        analyze = None
        if self._path_exists(self.terms_path(old)):
            from docforge.operators.analysis import field_postings
            analyze = lambda docs: field_postings(docs, "id", mapping, analyzer)
        return self.rebuild(alias, lambda: self.read(alias), mapping, analyzer, strict, analyze=analyze, accept=accept,
                            settings=self.declared_settings(old))

    def delete(self, alias: str) -> list[str]:
        """Delete an index: the alias view, every generation that belongs to it and
        their change logs. Returns the dropped generations; a missing alias
        is not an error."""
        dropped = self.generations(alias)
        self._versions(alias).drop()
        for kind in ("runs", "rejects"):
            self._delete_path(f"{self.root}/{kind}/{self.db}/{alias}")
        if self.is_view(alias):
            self.spark.sql(f"DROP VIEW {self.qualified(alias)}")
        for gen in dropped:
            self.drop_generation(gen)
        return dropped

    # ---- retire ---------------------------------------------------------------
    def retire_candidates(self, alias: str) -> DataFrame:
        """SNK-9: live generation plus unpublished leftovers of the alias, with document
        counts, oldest first; a concrete table that holds the alias's name is listed
        too. The live count is the alias's (generation and change log)."""
        live = self.live_generation(alias)
        names = self.generations(alias)
        if self.exists(alias) and not self.is_view(alias):
            names = sorted([*names, alias])
        frames = [self.spark.table(self.qualified(alias if n == live else n)).groupBy().count()
                  .select(F.lit(pos).alias("position"), F.lit(n).alias("generation"), F.lit(n == live).alias("live"),
                          F.col("count").alias("documents"))
                  for pos, n in enumerate(names, start=1)]
        if not frames:
            return self.spark.createDataFrame([], "position int, generation string, live boolean, documents bigint")
        return reduce(DataFrame.unionByName, frames).orderBy("generation")

    # ---- what the catalog holds ------------------------------------------------
    def catalog(self) -> list[dict]:
        """One entry per concrete table, in name order: its owner, the aliases that point at it, mapping, analyzer, strictness, settings,
        type of id and documents filled in. One listing and two reads of the manifest, however many tables; a table that is not in the
        manifest (made elsewhere, see :meth:`adopt`) has nothing declared and ``filled`` None."""
        names = sorted(t.name for t in self._tables() if t.tableType != "VIEW")
        known = {r["index"]: r for r in self.manifest.tables().collect()}
        pointing: dict[str, list[str]] = {}
        for r in self.manifest.aliases().orderBy("alias").collect():
            pointing.setdefault(r["index"], []).append(r["alias"])
        out = []
        for name in names:
            r = known.get(name)
            analyzer = json.loads(r["analyzer"]) if r else {}
            out.append({"index": name, "owner": r["owner"] if r else None, "aliases": pointing.get(name, []),
                        "mapping": {k: FieldSpec(*v) for k, v in json.loads(r["mapping"]).items()} if r else {},
                        "analyzer": AnalyzerSpec(analyzer.get("language"), analyzer.get("ascii_folding", True)),
                        "strict": bool(r) and r["dynamic"] == "strict", "settings": json.loads(r["settings"]) if r else {},
                        "id_type": r["id_type"] if r else None, "filled": r["filled"] if r else None})
        return out

    def indexes(self, entries: list[dict] | None = None) -> DataFrame:
        """``position``, ``index``, ``owner``, ``aliases`` and ``docs`` of every concrete table; a table behind an alias counts what the alias
        holds. Counts are the manifest's; only change logs (all in one job) and tables outside the manifest are read."""
        entries = self.catalog() if entries is None else entries
        rows = [(n, e["index"], e["owner"], e["aliases"], e["filled"] or 0) for n, e in enumerate(entries, 1)]
        frame = small_frame(self.spark, rows, "position int, index string, owner string, aliases array<string>, filled bigint")
        folders = set(self._folders(f"{self.root}/generations"))
        logged = [e for e in entries if e["aliases"] and e["filled"] is not None and f"{e['index']}__log" in folders and self._has_log(e["index"])]
        parts = [self.manifest.log_effect({e["index"]: self.log_path(e["index"]) for e in logged},
                                          {e["index"]: self.path_of(e["index"]) for e in logged},
                                          {e["index"]: e["id_type"] for e in logged})] if logged else []
        parts += [self.spark.table(self.qualified(e["index"])).groupBy().count().select(F.lit(e["index"]).alias("index"), F.col("count").alias("effect"))
                  for e in entries if e["filled"] is None]
        if not parts:
            return frame.withColumnRenamed("filled", "docs")
        effect = F.broadcast(reduce(DataFrame.unionByName, parts))  # a row a table
        return (frame.join(effect, "index", "left")
                .select("position", "index", "owner", "aliases", (F.col("filled") + F.coalesce("effect", F.lit(0))).alias("docs")))

    def settings(self, entries: list[dict] | None = None) -> DataFrame:
        """``index``, ``key``, ``value``: the flat settings that each table was made with."""
        rows = []
        for e in self.catalog() if entries is None else entries:
            if e["analyzer"].configured:
                rows += [(e["index"], "index.analysis.analyzer.docforge_text.tokenizer", "standard"),
                         (e["index"], "index.analysis.filter.docforge_stemmer.language", e["analyzer"].language)]
            if e["owner"] is not None:
                rows.append((e["index"], "index.mapping.dynamic", "strict" if e["strict"] else "true"))
            rows += [(e["index"], k, v) for k, v in sorted(e["settings"].items())]
        return small_frame(self.spark, rows, "index string, key string, value string")

    def mappings(self, entries: list[dict] | None = None) -> DataFrame:
        """``index``, ``field``, ``type``, ``has_keyword`` as frozen in each table."""
        rows = [(e["index"], f, spec.type, spec.has_keyword) for e in (self.catalog() if entries is None else entries)
                for f, spec in e["mapping"].items()]
        return small_frame(self.spark, rows, "index string, field string, type string, has_keyword boolean")

    def drop_database(self) -> None:
        """Remove the store's database, tables and files (scratch stores of tests and queries)."""
        for t in self._tables():
            if t.tableType != "VIEW":
                self.drop_generation(t.name)
        self.spark.sql(f"DROP DATABASE IF EXISTS {self.db} CASCADE")
        for kind in ("versions", "runs", "rejects", "manifest"):
            self._delete_path(f"{self.root}/{kind}/{self.db}")

    def _fs(self, path: str):
        hpath = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return hpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), hpath

    def _path_exists(self, path: str) -> bool:
        fs, hpath = self._fs(path)
        return fs.exists(hpath)

    def _delete_path(self, path: str) -> None:
        fs, hpath = self._fs(path)
        if fs.exists(hpath):
            fs.delete(hpath, True)


def last_per_id(documents: DataFrame, columns: list[str], order_by: str) -> DataFrame:
    """One row per id: the last one in ``order_by`` (ties: the larger row)."""
    body = [c for c in columns if c != "id"]
    row = F.struct(F.col(f"`{order_by}`").alias("__order"), *[F.col(f"`{c}`") for c in body])
    last = documents.groupBy("id").agg(F.max(row).alias("__last"))
    return last.select(*[F.col("id") if c == "id" else F.col(f"__last.`{c}`").alias(c) for c in columns])


def refuse_repeated_ids(rows: DataFrame) -> None:
    """Fail if an id occurs twice: counts over the id column alone, combined per task."""
    repeated = rows.groupBy("id").count().where("count > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"id {repeated[0]['id']!r} occurs {repeated[0]['count']} times; name the column that orders its rows (order_by)")


def _quoted(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
