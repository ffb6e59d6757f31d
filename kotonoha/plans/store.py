"""A corpus on shared storage: append-only Parquet logs and their views.

Layout::

    <root>/documents/gen=0/run_id=<k>/      registry of documents
    <root>/fetch/gen=0/run_id=<k>/          fetch events; "fetched" rows carry the text
    <root>/works/<work>/gen=0/run_id=<k>/   tokenize events; "done" rows carry the tokens,
                                            their token_info as ``packed_info`` has it

A run writes its own directory in one job and overwrites it when repeated, so a
crashed run leaves nothing visible and can be run again. Many works share one
set of documents and texts. Each table has one writer at a time. Views of the
fetch and tokenize logs start from the newest snapshot, see ``snapshots``.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kotonoha.functions.words import packed_info, unpacked_info, with_info
from kotonoha.operators.derived import derive_lists, fit_schema, list_problems, token_problems
from kotonoha.operators.reader import CorpusReader, collect_known, collect_tokens
from kotonoha.operators.tokenize import explode_lists, tokenize_lists
from kotonoha.plans import snapshots, status
from kotonoha.plans.layout import cut_lineage, fix_wide, remove_folder, wide_folder, wide_writer
from kotonoha.plans.numbering import number_rows
from kotonoha.schemas import DOCUMENTS, FETCH_LOG, TOKEN_LIST, TOKENIZE_LOG
from kotonoha.sources import files as file_source
from kotonoha.sources.content import content_pairs

# Files that Spark's reader opens by name in one group.
NAMED_FILES = 50_000
# Up to this many (doc_id, run_id) keys are broadcast to leave rows out or in.
BROADCAST_KEYS = 500_000
# ``process`` folds the state when this many runs have come since the last time.
SNAPSHOT_RUNS = 32

_GLOB_CHARACTERS = re.compile(r"([\[\]{}*?\\])")


def pick_rows(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose (doc_id, run_id) is in ``keys``, moving no row where avoidable.

    The rows are wide (texts, token lists) and the keys thin, so keys are
    fixed and counted first. Runs without a wanted row are not read. If few of the other
    rows are unwanted, or few are wanted, those keys are broadcast; only a large
    mixture is shuffled.
    """
    on = ["doc_id", "run_id"]
    keys = cut_lineage(keys.select(*on))
    # One row per run; as a broadcast side it prunes the directories that are read.
    rows = rows.join(F.broadcast(keys.select("run_id").distinct()), "run_id", "left_semi")
    unwanted = rows.select(*on).join(keys, on, "left_anti")
    n_unwanted = unwanted.limit(BROADCAST_KEYS + 1).count()
    if n_unwanted == 0:
        return rows
    if n_unwanted <= BROADCAST_KEYS:
        return rows.join(F.broadcast(unwanted), on, "left_anti")
    if keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
        return rows.join(F.broadcast(keys.select(*on)), on, "left_semi")
    return rows.join(keys, on, "left_semi")


class LogTable:
    """One append-only table of ``run_id=<k>`` directories with generations."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    # -- directory listing ------------------------------------------------

    def names(self, path: str, prefix: str) -> list[int]:
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(path)
        fs = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n[len(prefix):]) for n in names if n.startswith(prefix))

    def exists(self, path: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(place)

    def touch(self, path: str) -> None:
        """An empty file as a mark."""
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).create(place, True).close()

    def generation(self) -> int:
        """Newest generation whose compaction finished; 0 needs no marker."""
        found = [g for g in self.names(self.path, "gen=") if g]
        finished = [g for g in found if self.exists(f"{self.path}/gen={g}/_SUCCESS")]
        return max(finished, default=0)

    @property
    def folder(self) -> str:
        return f"{self.path}/gen={self.generation()}"

    def runs(self) -> list[int]:
        return self.names(self.folder, "run_id=")

    # -- rows ---------------------------------------------------------------

    def read(self, without: int | None = None, after: int | None = None) -> DataFrame:
        """All rows, those of the runs after one, or of all runs but one, which is being written."""
        folder = self.folder
        runs = [r for r in self.names(folder, "run_id=") if after is None or r > after]
        if not runs:
            return self.spark.createDataFrame([], self.schema)
        places = [folder] if after is None else [f"{folder}/run_id={r}" for r in runs]
        rows = self.spark.read.schema(self.schema).option("basePath", folder).parquet(*places)
        return rows if without is None else rows.where(F.col("run_id") != without)

    def append(self, rows: DataFrame, run_id: int) -> None:
        names = [f.name for f in self.schema if f.name != "run_id"]
        snapshots.mark_stale(self, run_id)
        wide_writer(rows.select(*names)).parquet(f"{self.folder}/run_id={run_id}")

    def compact(self, rows: DataFrame) -> None:
        """Write the surviving rows as the next generation; readers switch when it is whole.

        Rows are clustered by run first, so that a run becomes few files.
        """
        target = f"{self.path}/gen={max(self.names(self.path, 'gen='), default=0) + 1}"
        names = [f.name for f in self.schema]
        clustered = rows.select(*names).repartitionByRange("run_id", "doc_id")
        wide_writer(clustered).partitionBy("run_id").parquet(target)

    def remove(self, path: str) -> None:
        remove_folder(self.spark, path)

    def drop_older(self) -> None:
        """Remove the generations before the current one; no reader may still use them."""
        for old in self.names(self.path, "gen="):
            if old < self.generation():
                self.remove(f"{self.path}/gen={old}")


class CorpusStore:
    """Documents, texts and the tokens of one work."""

    def __init__(self, spark: SparkSession, root: str, work: str = "main"):
        self.spark, self.root, self.work_name = spark, root.rstrip("/"), work
        self.documents_table = LogTable(spark, f"{self.root}/documents", DOCUMENTS)
        self.fetch_table = LogTable(spark, f"{self.root}/fetch", FETCH_LOG)
        self.work_table = self._work(work)

    def _work(self, name: str) -> LogTable:
        return LogTable(self.spark, f"{self.root}/works/{name}", TOKENIZE_LOG)

    def with_work(self, name: str) -> CorpusStore:
        """The same documents and texts, another token table."""
        return CorpusStore(self.spark, self.root, name)

    def qualified(self, path: str) -> str:
        return file_source.qualified(self.spark, path)

    # -- views ----------------------------------------------------------------

    def documents(self) -> DataFrame:
        return self.documents_table.read().drop("run_id")

    def _fetch_state(self) -> DataFrame:
        return snapshots.read_state(self.fetch_table, snapshots.FETCH_RULE)

    def _work_state(self) -> DataFrame:
        return snapshots.read_state(self.work_table, snapshots.WORK_RULE)

    def fetch_status(self) -> DataFrame:
        return status.fetch_status(self._fetch_state())

    def tokenize_status(self) -> DataFrame:
        return status.tokenize_status(self._work_state(), self.fetch_status())

    def texts(self, wanted: DataFrame | None = None) -> DataFrame:
        """``[doc_id, char_count, text, text_version]`` of every fetched document.

        ``wanted`` (``[doc_id, text_version]``) asks for some of them only.
        """
        if wanted is None:
            wanted = self.fetch_status().where("fetch_ok")
        keys = wanted.select("doc_id", F.col("text_version").alias("run_id"))
        rows = pick_rows(self.fetch_table.read().where("event = 'fetched'"), keys)
        return rows.select("doc_id", "char_count", "text", F.col("run_id").alias("text_version"))

    def pending(self) -> DataFrame:
        return status.pending_documents(self._work_state(), self.fetch_status())

    def _stored_lists(self) -> DataFrame:
        """``[doc_id, tokens, text_version]`` of the rows a reader sees, as they are stored."""
        done = self.work_table.read().where("event = 'done'")
        rows = done.select("doc_id", "run_id", "tokens", "text_version")
        return pick_rows(rows, status.visible_runs(self._work_state())).drop("run_id")

    def _live_lists(self) -> DataFrame:
        """``[doc_id, tokens, text_version]`` of the rows a reader sees."""
        tokens = with_info(F.col("tokens"), unpacked_info).cast(TOKEN_LIST)
        return self._stored_lists().withColumn("tokens", tokens)

    def token_lists(self) -> DataFrame:
        """``[doc_id, tokens]`` a reader sees, one row per tokenized document."""
        return self._live_lists().drop("text_version")

    def tokens(self) -> DataFrame:
        """The long token table, ``[doc_id, token_id, word, pos, token_info]``."""
        # Unpacked as a column of its own, which readers of words alone do not ask for.
        tokens = explode_lists(self._stored_lists().select("doc_id", "tokens"))
        info = unpacked_info(F.col("token_info"), F.col("word"), F.col("pos"))
        return tokens.withColumn("token_info", info)

    def word_lists(self) -> DataFrame:
        """``[doc_id, words]`` from the stored lists: in order, NULL words dropped."""
        # Only these two fields of the lists are read.
        placed = F.zip_with(
            F.col("tokens.token_id"), F.col("tokens.word"), lambda i, w: F.struct(i.alias("at"), w.alias("word"))
        )
        words = F.filter(F.array_sort(placed)["word"], lambda w: w.isNotNull())
        lists = self._stored_lists().select("doc_id", words.alias("words"))
        return lists.where(F.size("words") > 0)

    def reader(self, return_mode: str = "tokens") -> CorpusReader:
        """Word lists per document, straight from the stored lists."""
        return CorpusReader(None, return_mode=return_mode, lists=self.word_lists())

    def failed_documents(self) -> DataFrame:
        return status.failed_documents(self.documents(), self.fetch_status())

    # -- registration -----------------------------------------------------------

    def _noted_run(self) -> int:
        """Largest run that a stream has noted for a batch, written or not."""
        notes = LogTable(self.spark, f"{self.root}/streams", FETCH_LOG)
        if not notes.exists(notes.path):
            return 0
        noted = self.spark.read.schema("run long").option("recursiveFileLookup", "true")
        return noted.parquet(notes.path).agg(F.max("run")).first()[0] or 0

    def next_master_run(self) -> int:
        return max(self._noted_run(), *self.documents_table.runs(), *self.fetch_table.runs(), 0) + 1

    def next_work_run(self) -> int:
        return max(self._noted_run(), *self.work_table.runs(), 0) + 1

    def _register(self, fresh: DataFrame, order_col: str, kind: str, run_id: int) -> None:
        """Number new ``[abs_path, rel_path]`` rows in order and append them."""
        known = self.documents_table.read(without=run_id)
        last = known.agg(F.max("doc_id")).first()[0] or 0
        numbered = number_rows(fresh, [order_col], output="doc_id", start=last + 1)
        rows = numbered.withColumn("source_kind", F.lit(kind)).withColumn(
            "created_at", F.current_timestamp()
        )
        self.documents_table.append(rows, run_id)

    def register_files(
        self,
        root_dir: str,
        patterns: str | Iterable[str] = file_source.DEFAULT_PATTERNS,
        *,
        run_id: int | None = None,
    ) -> None:
        """Register files below a folder; known paths are left alone, nothing is read."""
        listed = file_source.list_files(self.spark, root_dir, patterns)
        self.register_paths(listed, root_dir, run_id=run_id)

    def register_paths(self, listed: DataFrame, root_dir: str, *, run_id: int | None = None) -> None:
        """Register the new ones of a ``[path]`` listing, ids in path order."""
        run_id = run_id or self.next_master_run()
        known = self.documents_table.read(without=run_id)
        paths = listed.select(F.col("path").alias("abs_path")).distinct()
        fresh = paths.join(known, "abs_path", "left_anti").withColumn(
            "rel_path", file_source.relative_path(F.col("abs_path"), root_dir)
        )
        self._register(fresh, "abs_path", "file", run_id)
        event = self._event("registered", F.lit(None).cast("string"))
        # Not only this run's documents: an earlier run may have ended between its two tables.
        files = self.documents_table.read().where("source_kind = 'file'")
        rows = files.join(self.fetch_table.read(without=run_id), "doc_id", "left_anti")
        self.fetch_table.append(self._fetch_rows(rows, event), run_id)

    def register_content(
        self,
        content: DataFrame,
        id_col: str = "original_id",
        text_col: str = "text",
        *,
        order_col: str | None = None,
        source_label: str = "imported",
        run_id: int | None = None,
    ) -> None:
        """Upsert texts by original id; the last text of an id wins.

        NULL texts are ignored, "" is kept. A known id keeps its doc_id; its
        text gets a new version, which makes it pending in every work.
        """
        run_id = run_id or self.next_master_run()
        pairs = content_pairs(content, id_col, text_col, order_col)
        latest = status.latest_content(
            pairs, key_col="original_id", text_col="text", order_col="seq"
        )
        # Ids are given by arrival and texts joined afterwards: fix the arrival, while it is stored.
        arrival = wide_folder(self.spark)
        latest = fix_wide(
            latest.withColumn("abs_path", F.concat(F.lit(f"{source_label}://"), F.col("key"))), path=arrival
        )
        known = self.documents_table.read(without=run_id)
        fresh = latest.join(known, "abs_path", "left_anti").select(
            "abs_path", F.col("key").alias("rel_path"), "_first"
        )
        self._register(fresh, "_first", "content", run_id)
        ids = self.documents_table.read().select("doc_id", "abs_path")
        rows = latest.join(ids, "abs_path")
        fetched = rows.withColumn("char_count", F.length("text"))
        event = self._event("fetched", F.lit(None).cast("string"))
        self.fetch_table.append(self._fetch_rows(fetched, event), run_id)
        remove_folder(self.spark, arrival)

    # -- fetch --------------------------------------------------------------------

    @staticmethod
    def _event(name, error):
        label = F.lit(name) if isinstance(name, str) else name
        return [label.alias("event"), F.current_timestamp().alias("at"), error.alias("error")]

    @staticmethod
    def _fetch_rows(rows: DataFrame, event: list) -> DataFrame:
        nothing = {"char_count": "int", "text": "string"}
        tail = [
            F.col(c).cast(t).alias(c) if c in rows.columns else F.lit(None).cast(t).alias(c)
            for c, t in nothing.items()
        ]
        return rows.select("doc_id", *event, *tail)

    def _listing(self) -> DataFrame | None:
        """Files below all roots from which files were registered; None without any."""
        file_docs = self.documents().where("source_kind = 'file'")
        size = F.length("abs_path") - F.length("rel_path") - 1
        roots = file_docs.select(F.substr(F.col("abs_path"), F.lit(1), size).alias("folder")).distinct()
        return None if roots.isEmpty() else file_source.list_files(self.spark, roots, "*")

    def _contents(self, wanted: DataFrame) -> DataFrame:
        """``[doc_id, content, problem]`` of the wanted files, opened by name by the workers.

        Only names in a store that Arrow does not know go to Spark's reader, in groups.
        """
        scheme = F.regexp_extract("abs_path", "^[^:/]*:", 0)
        stores = wanted.groupBy(scheme.alias("scheme")).agg(F.min("abs_path").alias("one")).collect()
        unknown = [r["scheme"] for r in stores if not file_source.arrow_reads(r["one"])]
        if not unknown:
            return file_source.read_files(wanted)
        found = file_source.read_files(wanted.where(~scheme.isin(unknown)))
        named = wanted.where(scheme.isin(unknown)).select("abs_path", "doc_id")
        paths = (r["abs_path"] for r in named.toLocalIterator())
        while group := [_GLOB_CHARACTERS.sub(r"\\\1", p) for p in itertools.islice(paths, NAMED_FILES)]:
            read = self.spark.read.format("binaryFile").load(group).select(F.col("path").alias("abs_path"), "content")
            some = named.join(read, "abs_path").select("doc_id", "content", F.lit(None).cast("string").alias("problem"))
            found = found.unionByName(some)
        return found

    def _store_decoded(self, decoded: DataFrame, run_id: int) -> None:
        kind = F.when(F.col("error").isNull(), F.lit("fetched")).otherwise(F.lit("error"))
        self.fetch_table.append(self._fetch_rows(decoded, self._event(kind, F.col("error"))), run_id)

    def ingest(self, *, check_updates: bool = True) -> None:
        """Read new and changed files as strict UTF-8; errors stay with their document."""
        listing = self._listing() if check_updates else None
        wanted = status.select_updates(
            self.documents(), self.fetch_status(), listing, check_updates=listing is not None
        )
        wanted = cut_lineage(wanted)
        if wanted.isEmpty():
            return
        decoded = file_source.decode_utf8(self._contents(wanted))
        self._store_decoded(decoded, self.next_master_run())

    def redecode_failed(self, charset: str) -> None:
        """Read failed files again in another charset; the files stay as they are."""
        failed = self.failed_documents().select("doc_id", "abs_path")
        file_docs = self.documents().where("source_kind = 'file'").select("doc_id")
        wanted = cut_lineage(failed.join(file_docs, "doc_id", "left_semi"))
        if wanted.isEmpty():
            return
        decoded = file_source.decode_charset(self._contents(wanted), charset)
        self._store_decoded(decoded, self.next_master_run())

    # -- tokenize -----------------------------------------------------------------

    def tokenize(
        self,
        tokenizer=None,
        *,
        doc_ids: Sequence[int] | DataFrame | None = None,
        word_form: str | None = None,
        run_id: int | None = None,
    ) -> None:
        """Tokenize pending texts, or the listed documents in any case.

        A failing document gets an error row; its earlier tokens stay visible.
        An empty list does nothing.
        """
        if doc_ids is None:
            wanted = self.pending()
        else:
            listed = self._id_table(doc_ids)
            if listed is None:
                return
            fetched = self.fetch_status().where("fetch_ok")
            wanted = fetched.select("doc_id", "text_version").join(listed, "doc_id", "left_semi")
        texts = self.texts(cut_lineage(wanted))
        self._tokenize_texts(texts, tokenizer, word_form, run_id or self.next_work_run())

    reprocess = tokenize

    def _tokenize_texts(self, texts: DataFrame, tokenizer, word_form, run_id: int) -> None:
        lists = tokenize_lists(texts, tokenizer, word_form=word_form, packed=True, carry=("text_version",))
        self._append_lists(lists, self.work_table, run_id, packed=True)

    def _append_lists(self, lists: DataFrame, table: LogTable, run_id: int, *, packed: bool = False) -> None:
        failed = F.col("error").isNotNull()
        kind = F.when(failed, F.lit("error")).otherwise(F.lit("done"))
        stored = F.col("tokens") if packed else with_info(F.col("tokens"), packed_info)
        tokens = F.when(~failed, stored).cast(TOKEN_LIST)
        rows = lists.select(
            "doc_id", *self._event(kind, F.col("error")), "text_version", tokens.alias("tokens")
        )
        table.append(rows, run_id)

    def process(self, tokenizer=None, *, fetch_only: bool = False, check_updates: bool = True) -> None:
        """Ingest, then tokenize unless ``fetch_only``; now and then the state is folded."""
        self.ingest(check_updates=check_updates)
        if not fetch_only:
            self.tokenize(tokenizer)
        if max(map(snapshots.runs_since, (self.fetch_table, self.work_table))) >= SNAPSHOT_RUNS:
            self.snapshot()

    def _id_table(self, doc_ids) -> DataFrame | None:
        if isinstance(doc_ids, DataFrame):
            return doc_ids.select("doc_id").distinct()
        ids = sorted({int(d) for d in doc_ids})
        return self.spark.createDataFrame([(d,) for d in ids], "doc_id long") if ids else None

    def replace_tokens(self, tokens: DataFrame, documents: DataFrame) -> DataFrame:
        """Store a token table made elsewhere for these documents.

        Documents that break the token contract are left as they were and
        returned as ``[doc_id, problem, n]``; all others are replaced and done,
        also when they have no token.
        """
        problems = cut_lineage(token_problems(tokens, documents, require_word=False))
        clean = documents.select("doc_id").distinct().join(problems, "doc_id", "left_anti")
        lists = collect_tokens(tokens)
        empty = F.array().cast(TOKEN_LIST)
        versions = self.fetch_status().where("fetch_ok").select("doc_id", "text_version")
        rows = (
            clean.join(lists, "doc_id", "left")
            .withColumn("tokens", F.coalesce("tokens", empty))
            .withColumn("error", F.lit(None).cast("string"))
            .join(versions, "doc_id")
        )
        self._append_lists(rows, self.work_table, self.next_work_run())
        return problems

    # -- status changes -------------------------------------------------------------

    def _status_rows(self, ids: DataFrame, event: str) -> DataFrame:
        return ids.select(
            "doc_id",
            *self._event(event, F.lit(None).cast("string")),
            F.lit(None).cast("long").alias("text_version"),
            F.lit(None).cast(TOKEN_LIST).alias("tokens"),
        )

    def reset_tokens(self, doc_ids: Sequence[int] | DataFrame | None = None) -> None:
        """Hide the tokens of all or the listed documents and make fetched ones pending.

        Unfetched documents have no text to tokenize and never count as pending.
        """
        wanted = None
        if doc_ids is not None:
            wanted = self._id_table(doc_ids)
            if wanted is None:
                return
        rows = status.reset_rows(self._work_state(), wanted)
        self.work_table.append(self._status_rows(rows, "reset"), self.next_work_run())

    def sync_status(self) -> None:
        """Add master documents this work has not seen; existing rows stay."""
        rows = status.missing_status(self._work_state(), self._fetch_state())
        self.work_table.append(self._status_rows(rows, "registered"), self.next_work_run())

    # -- derived works ----------------------------------------------------------------

    def derive(
        self,
        name: str,
        transform: Callable,
        *,
        pandas: bool = False,
        lists: bool = False,
    ) -> CorpusStore:
        """A new work whose tokens are a transform of this work's tokens.

        A DataFrame transform stays a Spark plan; with ``pandas`` the function
        gets token frames of whole documents, where they are read. With
        ``lists`` it is a rule on ``[doc_id, tokens]`` rows such as
        ``filtered_lists``, and no token is regrouped or shuffled. Every document with a text is
        marked done unless its output breaks the token rules. Rows of no or of an
        unknown document are in ``problems`` of the returned store.
        """
        if not callable(transform):
            raise TypeError("transform must be callable")
        target = self._work(name)
        run_id = self.with_work(name).next_work_run()
        versions = self.fetch_status().where("fetch_ok").select("doc_id", "text_version")
        fixed = None
        if pandas or lists:
            live = self._live_lists()
            if pandas:
                rows = derive_lists(live, transform, carry=("text_version",))
            else:
                error = F.concat_ws(", ", *list_problems(F.col("tokens")))
                rows = transform(live).select(
                    "doc_id",
                    F.coalesce("tokens", F.array().cast(TOKEN_LIST)).alias("tokens"),
                    F.nullif(error, F.lit("")).alias("error"),
                    "text_version",
                )
            # Texts never tokenized here have nothing to transform and are done.
            blank = versions.join(live.select("doc_id"), "doc_id", "left_anti").select(
                "doc_id",
                F.array().cast(TOKEN_LIST).alias("tokens"),
                F.lit(None).cast("string").alias("error"),
                "text_version",
            )
            rows = rows.unionByName(blank)
            problems = self.spark.createDataFrame([], "doc_id long, problem string, n long")
        else:
            fixed = wide_folder(self.spark)
            rows, problems = self._derive_plan(transform, versions, fixed)
        derived = self.with_work(name)
        derived.problems = problems
        # A rebuilt work hides what an older build left for failing documents.
        if target.runs():
            derived.reset_tokens()
            run_id += 1
        self._append_lists(rows, target, run_id, packed=fixed is not None)
        if fixed:
            remove_folder(self.spark, fixed)
        return derived

    def _derive_plan(self, transform: Callable, versions: DataFrame, fixed: str) -> tuple[DataFrame, DataFrame]:
        """``[doc_id, tokens, error, text_version]`` of a DataFrame transform, and its problems.

        The output is regrouped once, its token_info packed, and the token rules are
        read off the lists. Rows of no or of an unknown document come back as problems.
        The lists lie in the folder ``fixed``, which only the problems do not need.
        """
        result = transform(self.tokens())
        empty = F.array().cast(TOKEN_LIST)
        none = self.spark.createDataFrame([], "doc_id long, problem string, n long")
        if result is None:
            return versions.withColumn("tokens", empty).withColumn("error", F.lit(None).cast("string")), none
        # The transform runs once, also where it gives other rows each time.
        tokens = fit_schema(result)
        tokens = tokens.withColumn("token_info", packed_info(F.col("token_info"), F.col("word"), F.col("pos")))
        lists = fix_wide(collect_known(tokens, versions, carry=("text_version",)), path=fixed)
        error = F.concat_ws(", ", *list_problems(F.col("tokens")))
        rows = lists.where("known").select(
            "doc_id", "tokens", F.nullif(error, F.lit("")).alias("error"), "text_version"
        )
        blank = versions.join(lists.select("doc_id"), "doc_id", "left_anti")
        blank = blank.withColumn("tokens", empty).withColumn("error", F.lit(None).cast("string"))
        rows = rows.unionByName(blank)
        problem = F.when(F.col("doc_id").isNull(), F.lit("null_key")).otherwise(F.lit("foreign_doc"))
        problems = lists.where("NOT known").select("doc_id", problem.alias("problem"), "n")
        return rows, cut_lineage(problems)

    # -- maintenance ------------------------------------------------------------------

    def snapshot(self) -> None:
        """Fold the state of every document up to the newest run of its log and keep it.

        Later views read it and the rows of newer runs only. A writer's action.
        """
        snapshots.write_snapshot(self.fetch_table, snapshots.FETCH_RULE)
        snapshots.write_snapshot(self.work_table, snapshots.WORK_RULE)

    def compact(self, *, drop_older: bool = False) -> None:
        """Rewrite the logs of documents, fetches and this work without rows no view needs.

        Wide rows are picked by thin keys and moved once, to cluster them by
        run, and the state is folded anew. ``drop_older`` then frees the space of earlier generations; leave it
        off while another session reads them.
        """
        log, fetched = self.work_table.read(), self.fetch_table.read()
        done = _last_run("done"), _last_run("reset"), _last_run("done", "error", "reset"), F.max("run_id")
        read = _last_run("fetched"), _last_run("fetched", "error"), F.max("run_id")
        self.work_table.compact(pick_rows(log, _needed_runs(log, done)))
        self.fetch_table.compact(pick_rows(fetched, _needed_runs(fetched, read)))
        self.documents_table.compact(self.documents_table.read())
        self.snapshot()
        if drop_older:
            for table in (self.work_table, self.fetch_table, self.documents_table):
                table.drop_older()


def _last_run(*events: str) -> Column:
    return F.max(F.when(F.col("event").isin(*events), F.col("run_id")))


def _needed_runs(log: DataFrame, needed: Iterable[Column]) -> DataFrame:
    """``[doc_id, run_id]``: the runs of each document that a view still reads."""
    per_doc = log.groupBy("doc_id").agg(F.array_distinct(F.array_compact(F.array(*needed))).alias("_runs"))
    return per_doc.select("doc_id", F.explode("_runs").alias("run_id"))
