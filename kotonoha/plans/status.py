"""State of a corpus as views over append-only logs.

Every stage appends rows stamped with a growing ``run_id`` and never changes
old ones. A log row is the state of its document after that one event; states
fold to one row per document, and folded ones fold on, so the state up to a run
can be kept and only newer rows are added. A document with a third of all log
rows meets as partial aggregates. The views read states.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A file counts as changed when its mtime is later than this after the fetch.
MTIME_MARGIN_SECONDS = 1.0



def _state_of_event(log: DataFrame, kinds: dict[str, tuple[str, ...]], columns: dict[str, tuple[str, str]]) -> DataFrame:
    """Log rows as states: each column is a log column where the event is of a kind."""
    return log.select(
        "doc_id",
        *[
            F.when(F.col("event").isin(*kinds[kind]), F.col(source)).alias(name)
            for name, (kind, source) in columns.items()
        ],
    )


def fetch_events(log: DataFrame) -> DataFrame:
    """A fetch log as states, one per row."""
    return _state_of_event(
        log,
        {"fetched": ("fetched",), "attempt": ("fetched", "error")},
        {
            "fetched_run": ("fetched", "run_id"),
            "fetched_at": ("fetched", "at"),
            "attempt_run": ("attempt", "run_id"),
            "attempt_at": ("attempt", "at"),
            "attempt_error": ("attempt", "error"),
        },
    )


def fold_fetch(states: DataFrame) -> DataFrame:
    """States of fetching to one per document; only the newest attempt's error stays."""
    return states.groupBy("doc_id").agg(
        F.max("fetched_run").alias("fetched_run"),
        F.max_by("fetched_at", "fetched_run").alias("fetched_at"),
        F.max("attempt_run").alias("attempt_run"),
        F.max("attempt_at").alias("attempt_at"),
        F.max_by("attempt_error", "attempt_run").alias("attempt_error"),
    )


def work_events(log: DataFrame) -> DataFrame:
    """A tokenize log as states, one per row."""
    return _state_of_event(
        log,
        {
            "done": ("done",),
            "reset": ("reset",),
            "tried": ("done", "error"),
            "shown": ("done", "error", "reset"),
        },
        {
            "done_run": ("done", "run_id"),
            "done_version": ("done", "text_version"),
            "reset_run": ("reset", "run_id"),
            "tried_run": ("tried", "run_id"),
            "shown_run": ("shown", "run_id"),
            "shown_at": ("shown", "at"),
            "shown_error": ("shown", "error"),
            "shown_version": ("shown", "text_version"),
        },
    )


def fold_work(states: DataFrame) -> DataFrame:
    """States of tokenizing to one per document."""
    return states.groupBy("doc_id").agg(
        F.max("done_run").alias("done_run"),
        F.max_by("done_version", "done_run").alias("done_version"),
        F.max("reset_run").alias("reset_run"),
        F.max("tried_run").alias("tried_run"),
        F.max("shown_run").alias("shown_run"),
        F.max("shown_at").alias("shown_at"),
        F.max_by("shown_error", "shown_run").alias("shown_error"),
        F.max_by("shown_version", "shown_run").alias("shown_version"),
    )


def fetch_state(log: DataFrame) -> DataFrame:
    return fold_fetch(fetch_events(log))


def work_state(log: DataFrame) -> DataFrame:
    return fold_work(work_events(log))


def fetch_status(state: DataFrame) -> DataFrame:
    """``[doc_id, fetch_ok, text_version, fetched_at, error_message, updated_at]``.

    fetch_ok stays true after a later failed attempt; the error shows as long
    as the latest attempt failed.
    """
    return state.select(
        "doc_id",
        F.col("fetched_run").isNotNull().alias("fetch_ok"),
        F.col("fetched_run").alias("text_version"),
        "fetched_at",
        F.col("attempt_error").alias("error_message"),
        F.col("attempt_at").alias("updated_at"),
    )


def _has_tokens() -> Column:
    """Tokenized, and not reset later."""
    return F.coalesce(F.col("done_run") > F.coalesce("reset_run", F.lit(-1)), F.lit(False))


def _is_done(version: Column) -> Column:
    return F.coalesce(_has_tokens() & (F.col("done_version") == version), F.lit(False))


def tokenize_status(state: DataFrame, fetched: DataFrame) -> DataFrame:
    """``[doc_id, tokenize_ok, error_message, updated_at]`` against the current text.

    A changed text clears tokenize_ok and an old error. Documents known to the
    fetch view appear even before their first tokenize row.
    """
    versions = fetched.select("doc_id", F.col("text_version").alias("_version"))
    joined = versions.join(state, "doc_id", "left")
    error = F.when(F.col("shown_version") == F.col("_version"), F.col("shown_error"))
    return joined.select(
        "doc_id",
        _is_done(F.col("_version")).alias("tokenize_ok"),
        error.alias("error_message"),
        F.col("shown_at").alias("updated_at"),
    )


def pending_documents(state: DataFrame, fetched: DataFrame) -> DataFrame:
    """``[doc_id, text_version]`` fetched but not tokenized at this text version."""
    ready = fetched.where("fetch_ok").select("doc_id", "text_version")
    return (
        ready.join(state, "doc_id", "left")
        .where(~_is_done(F.col("text_version")))
        .select("doc_id", "text_version")
    )


def visible_runs(state: DataFrame) -> DataFrame:
    """``[doc_id, run_id]`` of the tokens a reader sees: newest done run, unless reset later.

    A changed text does not hide the old tokens; only a reset does.
    """
    return state.where(_has_tokens()).select("doc_id", F.col("done_run").alias("run_id"))


def reset_rows(state: DataFrame, doc_ids: DataFrame | None = None) -> DataFrame:
    """``[doc_id]`` that a reset has to touch: documents with tokens or with an error.

    ``doc_ids`` limits it to those documents.
    """
    tried = state.where(F.col("tried_run").isNotNull()).select("doc_id")
    return tried if doc_ids is None else tried.join(doc_ids.select("doc_id"), "doc_id", "left_semi")


def missing_status(state: DataFrame, fetched: DataFrame) -> DataFrame:
    """``[doc_id]`` known to the master but not yet to this work; any tables with ids will do."""
    return fetched.select("doc_id").distinct().join(state, "doc_id", "left_anti")


def failed_documents(documents: DataFrame, fetched: DataFrame) -> DataFrame:
    """Documents never fetched whose last attempt left an error."""
    bad = fetched.where(~F.col("fetch_ok") & F.col("error_message").isNotNull())
    return documents.select("doc_id", "abs_path").join(
        bad.select("doc_id", "error_message"), "doc_id"
    )


def select_updates(
    documents: DataFrame, fetched: DataFrame, files: DataFrame | None, *, check_updates: bool = True
) -> DataFrame:
    """``[doc_id, abs_path]`` of file documents to read now.

    Never fetched, or (with ``check_updates``) the file exists and was modified
    more than the margin after the fetch, or the fetch time is unknown. A
    never-fetched document is taken even when its file is gone, so that the
    failure gets recorded.
    """
    known = documents.where(F.col("source_kind") == "file").select("doc_id", "abs_path")
    state = fetched.select("doc_id", "fetch_ok", "fetched_at")
    never = ~F.col("fetch_ok")
    if not check_updates:
        return known.join(state, "doc_id").where(never).select("doc_id", "abs_path")
    listed = files.select(F.col("path").alias("abs_path"), F.col("modificationTime").alias("_mtime"))
    joined = known.join(state, "doc_id").join(listed, "abs_path", "left")
    margin = F.expr(f"INTERVAL {MTIME_MARGIN_SECONDS} SECOND")
    changed = F.col("_mtime").isNotNull() & (
        F.col("fetched_at").isNull() | (F.col("_mtime") > F.col("fetched_at") + margin)
    )
    return joined.where(never | F.coalesce(changed, F.lit(False))).select("doc_id", "abs_path")


def latest_content(content: DataFrame, *, key_col: str, text_col: str, order_col: str) -> DataFrame:
    """``[key, text, _first]``: last non-NULL text of every key, and where it first came.

    The newest text wins map-side first, so copies of one key never gather.
    """
    return (
        content.where(F.col(text_col).isNotNull())
        .groupBy(F.col(key_col).alias("key"))
        .agg(
            F.max_by(F.col(text_col), F.col(order_col)).alias("text"),
            F.min(order_col).alias("_first"),
        )
    )
