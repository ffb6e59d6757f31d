"""Registration, fetch and tokenize state, contract checks, packing."""

from __future__ import annotations

import re
import time

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import functions as F

from kotonoha.checks.common import doc_tokens, documents, registry, scratch, sql_tokens, table, with_tokens
from kotonoha.operators.derived import token_problems
from kotonoha.operators.lists import filter_lists
from kotonoha.operators.packing import pack_documents
from kotonoha.plans import status
from kotonoha.plans.numbering import number_rows
from kotonoha.plans.store import CorpusStore
from kotonoha.sources.content import read_csv
from kotonoha.sources.files import decode_charset, decode_utf8

QUERIES, ORACLES, check = registry()


# -- logs made of the events table: one user is one document -------------------

# Which event type stands for which log event.
FETCH_EVENTS = {"signup": "registered", "view": "fetched", "click": "fetched", "error": "error", "purchase": "registered"}
TOKENIZE_EVENTS = {"purchase": "done", "signup": "registered", "error": "error", "click": "reset", "view": "registered"}


def _log(spark, folder, names):
    events = table(spark, folder, "events")
    kind = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return events.select(
        F.col("user_id").alias("doc_id"),
        kind[F.col("event_type")].alias("event"),
        F.col("ts").alias("at"),
        F.col("event_id").alias("run_id"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("error"),
        # Runs of a thousand events share a text version.
        F.floor(F.col("event_id") / 1000).cast("long").alias("text_version"),
    ).where(F.col("event").isNotNull())


def _fetch_log(spark, folder):
    return _log(spark, folder, FETCH_EVENTS)


def _version_log(spark, folder):
    """Fetch log whose run ids are the shared text versions."""
    return _fetch_log(spark, folder).withColumn("run_id", F.col("text_version"))


def _tokenize_log(spark, folder):
    return _log(spark, folder, TOKENIZE_EVENTS)


def _case(names):
    return " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.items())


def _sql_log(names):
    return f"""SELECT user_id AS doc_id, CASE event_type {_case(names)} END AS event, ts AS seen_at,
                      event_id AS run_id, CASE WHEN event_type = 'error' THEN props END AS error,
                      event_id // 1000 AS text_version
               FROM events WHERE event_type IN ({", ".join(f"'{k}'" for k in names)})"""


_LOGS = f"WITH f AS ({_sql_log(FETCH_EVENTS)}), t AS ({_sql_log(TOKENIZE_EVENTS)})"
_FETCHED = """fs AS (
  SELECT doc_id, max(run_id) FILTER (event = 'fetched') AS last_fetched,
         max(text_version) FILTER (event = 'fetched') AS text_version,
         max(seen_at) FILTER (event = 'fetched') AS fetched_at,
         arg_max(event, run_id) FILTER (event IN ('fetched', 'error')) AS newest,
         max(run_id) FILTER (event = 'error') AS last_error
  FROM f GROUP BY doc_id)"""
_RUNS = """ts AS (
  SELECT doc_id, coalesce(max(run_id) FILTER (event = 'done'), -1) AS last_done,
         coalesce(max(run_id) FILTER (event = 'reset'), -1) AS last_reset,
         arg_max(text_version, run_id) FILTER (event = 'done') AS done_version
  FROM t GROUP BY doc_id)"""


@check(
    "fetch_status",
    f"""{_LOGS}, {_FETCHED}
    SELECT fs.doc_id, last_fetched IS NOT NULL AS fetch_ok, last_fetched AS text_version, fetched_at,
           CASE WHEN newest = 'error' THEN e.error END AS error_message
    FROM fs LEFT JOIN f e ON e.doc_id = fs.doc_id AND e.run_id = fs.last_error""",
)
def _(spark, folder):
    return status.fetch_status(status.fetch_state(_fetch_log(spark, folder))).drop("updated_at")


@check(
    "failed",
    f"""{_LOGS.replace("WITH f AS", "WITH f0 AS")},
    f AS (SELECT * FROM f0 WHERE NOT (event = 'fetched' AND doc_id % 2 = 0)),
    {_FETCHED}
    SELECT c.c_custkey AS doc_id, c.c_name AS abs_path, e.error AS error_message
    FROM fs JOIN customer c ON c.c_custkey = fs.doc_id
    JOIN f e ON e.doc_id = fs.doc_id AND e.run_id = fs.last_error
    WHERE last_fetched IS NULL AND newest = 'error'""",
)
def _(spark, folder):
    """Never-fetched documents whose last attempt failed (even documents never get fetched)."""
    log = _fetch_log(spark, folder).where(
        ~((F.col("event") == "fetched") & (F.col("doc_id") % 2 == 0))
    )
    registry = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("doc_id"), F.col("c_name").alias("abs_path")
    )
    return status.failed_documents(registry, status.fetch_status(status.fetch_state(log)))


_DONE = "(last_done > last_reset AND done_version = fs.text_version)"


@check(
    "pending",
    f"""{_LOGS}, {_FETCHED}, {_RUNS}
    SELECT fs.doc_id, fs.text_version FROM fs LEFT JOIN ts USING (doc_id)
    WHERE last_fetched IS NOT NULL AND NOT coalesce({_DONE}, false)""",
)
def _(spark, folder):
    fetched = status.fetch_status(status.fetch_state(_version_log(spark, folder)))
    return status.pending_documents(status.work_state(_tokenize_log(spark, folder)), fetched)


@check(
    "tokenize_status",
    f"""{_LOGS}, {_FETCHED}, {_RUNS},
    n AS (SELECT doc_id, max(seen_at) AS updated_at, arg_max(coalesce(error, ''), run_id) AS error,
                 arg_max(text_version, run_id) AS v
          FROM t WHERE event <> 'registered' GROUP BY doc_id)
    SELECT fs.doc_id, coalesce({_DONE}, false) AS tokenize_ok,
           CASE WHEN v = fs.text_version THEN nullif(error, '') END AS error_message, n.updated_at
    FROM fs LEFT JOIN ts USING (doc_id) LEFT JOIN n ON n.doc_id = fs.doc_id""",
)
def _(spark, folder):
    fetched = status.fetch_status(status.fetch_state(_version_log(spark, folder)))
    return status.tokenize_status(status.work_state(_tokenize_log(spark, folder)), fetched)


@check(
    "replace_visible",
    f"{_LOGS}, {_RUNS} SELECT doc_id, last_done AS run_id FROM ts WHERE last_done > last_reset",
)
def _(spark, folder):
    """The run whose tokens a reader sees after replacements and resets."""
    return status.visible_runs(status.work_state(_tokenize_log(spark, folder)))


@check(
    "reset",
    f"""{_LOGS} SELECT DISTINCT doc_id FROM t
        WHERE event IN ('done', 'error') AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)""",
)
def _(spark, folder):
    wanted = table(spark, folder, "labels").where("quality = 1")
    return status.reset_rows(status.work_state(_tokenize_log(spark, folder)), wanted)


@check("sync", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _(spark, folder):
    """Master documents that a work does not know yet."""
    return status.missing_status(table(spark, folder, "labels"), documents(spark, folder))


# -- registration ------------------------------------------------------------------


@check(
    "register",
    """SELECT row_number() OVER (ORDER BY url) + 1000 AS doc_id, url AS abs_path
       FROM (SELECT DISTINCT url FROM pages) WHERE url NOT IN (SELECT url FROM pages WHERE page_id % 3 = 0)""",
)
def _(spark, folder):
    """New paths get consecutive ids in path order, known paths none."""
    pages = table(spark, folder, "pages").select("page_id", F.col("url").alias("abs_path"))
    known = pages.where("page_id % 3 = 0").select("abs_path")
    fresh = pages.select("abs_path").distinct().join(known, "abs_path", "left_anti")
    return number_rows(fresh, ["abs_path"], output="doc_id", start=1001)


_KEYED = """SELECT coalesce(regexp_extract(url, '^https?://([^/]*)', 1), '') AS key, page_id AS seq,
                   CASE WHEN page_id % 7 <> 0 THEN html END AS text FROM pages"""


@check(
    "upsert",
    f"""SELECT row_number() OVER (ORDER BY min(seq)) AS doc_id, 'site://' || key AS abs_path,
               arg_max(text, seq) AS text, length(arg_max(text, seq)) AS char_count
        FROM ({_KEYED}) WHERE text IS NOT NULL GROUP BY key""",
)
def _(spark, folder):
    """Content upsert into a store: pages of a site overwrite each other, last wins."""
    pages = table(spark, folder, "pages").select(
        F.regexp_extract("url", "^https?://([^/]*)", 1).alias("key"),
        F.col("page_id").alias("seq"),
        F.when(F.col("page_id") % 7 != 0, F.col("html")).alias("text"),
    )
    store = CorpusStore(spark, scratch(spark, "upsert"))
    store.register_content(pages, "key", "text", order_col="seq", source_label="site")
    store.register_content(
        pages.where("seq % 2 = 1"), "key", "text", order_col="seq", source_label="site"
    )
    store.register_content(pages, "key", "text", order_col="seq", source_label="site")
    return (
        store.texts()
        .join(store.documents(), "doc_id")
        .select("doc_id", "abs_path", "text", F.col("char_count").cast("long").alias("char_count"))
    )


@check(
    "csv_import",
    "SELECT 'csv://' || doc_id AS abs_path, text, length(text) AS char_count FROM documents",
)
def _(spark, folder):
    """Texts through a CSV file, with their line breaks and quotes."""
    path = scratch(spark, "csv")
    source = documents(spark, folder).withColumn("doc_id", F.col("doc_id").cast("string"))
    source.write.options(header="true", escape='"', quoteAll="true").csv(path)
    store = CorpusStore(spark, scratch(spark, "csv-store"))
    store.register_content(read_csv(spark, path, "doc_id", "text"), source_label="csv")
    return (
        store.texts()
        .join(store.documents(), "doc_id")
        .select("abs_path", "text", F.col("char_count").cast("long").alias("char_count"))
    )


@check(
    "select_updates",
    f"""{_LOGS}, {_FETCHED},
    files AS (SELECT o_custkey AS doc_id, max(o_orderdate) + INTERVAL 30 YEAR AS mtime
              FROM orders WHERE o_custkey % 5 <> 0 GROUP BY o_custkey)
    SELECT c.c_custkey AS doc_id, c.c_name AS abs_path
    FROM customer c JOIN fs ON fs.doc_id = c.c_custkey LEFT JOIN files ON files.doc_id = c.c_custkey
    WHERE last_fetched IS NULL OR mtime > fetched_at + INTERVAL 1 SECOND""",
)
def _(spark, folder):
    """Never fetched, or modified since; order dates play the file times."""
    registry = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("doc_id"),
        F.col("c_name").alias("abs_path"),
        F.lit("file").alias("source_kind"),
    )
    orders = table(spark, folder, "orders").where("o_custkey % 5 <> 0")
    mtimes = orders.groupBy(F.col("o_custkey").alias("doc_id")).agg(
        (F.max("o_orderdate") + F.expr("INTERVAL 30 YEAR")).alias("modificationTime")
    )
    files = mtimes.join(registry, "doc_id").select(
        F.col("abs_path").alias("path"), "modificationTime"
    )
    fetched = status.fetch_status(status.fetch_state(_fetch_log(spark, folder)))
    return status.select_updates(registry, fetched, files)


# -- decoding ------------------------------------------------------------------------


@check(
    "decode",
    """SELECT page_id, CASE WHEN page_id % 4 <> 0 THEN replace(replace(t, chr(13) || chr(10), chr(10)), chr(13), chr(10)) END AS text,
              CASE WHEN page_id % 4 <> 0 THEN CAST(length(t) - page_id % 2 AS INTEGER) END AS char_count,
              page_id % 4 = 0 AS failed
       FROM (SELECT page_id, html || CASE WHEN page_id % 2 = 1 THEN chr(13) || chr(10) ELSE chr(13) END AS t FROM pages)""",
)
def _(spark, folder):
    """Strict UTF-8 with the error kept per document; line ends unified."""
    end = F.when(F.col("page_id") % 2 == 1, F.lit("\r\n")).otherwise(F.lit("\r"))
    content = F.concat(F.col("html"), end).cast("binary")
    broken = F.concat(content, F.unhex(F.lit("E38081FF")))
    pages = table(spark, folder, "pages").select(
        "page_id", F.when(F.col("page_id") % 4 == 0, broken).otherwise(content).alias("content")
    )
    return decode_utf8(pages).select(
        "page_id", "text", "char_count", F.col("error").isNotNull().alias("failed")
    )


@check(
    "decode_charset",
    "SELECT page_id, html AS text, CAST(length(html) AS INTEGER) AS char_count, false AS failed FROM pages",
)
def _(spark, folder):
    """The same texts stored in another charset and read back."""
    pages = table(spark, folder, "pages").select(
        "page_id", F.encode("html", "UTF-16BE").alias("content")
    )
    return decode_charset(pages, "utf-16-be").select(
        "page_id", "text", "char_count", F.col("error").isNotNull().alias("failed")
    )


# -- contract and packing ----------------------------------------------------------------


@check(
    "contract",
    with_tokens(
        """, b AS (SELECT doc_id, CASE WHEN word = 'Das' THEN NULL WHEN contains(word, 'rr') THEN 0 ELSE token_id END AS token_id,
                          CASE WHEN word <> '%' THEN word END AS word FROM tok),
             per AS (SELECT doc_id, token_id, count(*) AS n FROM b GROUP BY ALL),
             known AS (SELECT doc_id FROM labels)
        SELECT doc_id, 'null_key' AS problem, count(*) AS n FROM b WHERE token_id IS NULL GROUP BY doc_id
        UNION ALL SELECT doc_id, 'null_word', count(*) FROM b WHERE word IS NULL GROUP BY doc_id
        UNION ALL SELECT doc_id, 'duplicate', CAST(sum(n) AS BIGINT) FROM per
                  WHERE token_id IS NOT NULL AND n > 1 GROUP BY doc_id
        UNION ALL SELECT doc_id, 'foreign_doc', count(*) FROM b WHERE doc_id NOT IN (FROM known) GROUP BY doc_id"""
    ),
)
def _(spark, folder):
    """Broken rules per document of a damaged token table."""
    damaged = doc_tokens(spark, folder, info_col=None)
    word = F.col("word")
    token_id = F.when(word == "Das", F.lit(None)).when(word.contains("rr"), F.lit(0)).otherwise(
        F.col("token_id")
    )
    damaged = damaged.withColumn("token_id", token_id).withColumn("word", F.when(word != "%", word))
    return token_problems(damaged, table(spark, folder, "labels"))


def sql_pack(max_chars: int, max_docs: int, key: str) -> str:
    """The greedy rule, one recursion step per place in its key's walk."""
    return f"""
    WITH RECURSIVE d AS (
      SELECT {key} AS key, doc_id, n_chars AS char_count,
             row_number() OVER (PARTITION BY {key} ORDER BY doc_id) AS i FROM documents),
    walk AS (
      SELECT key, i, doc_id, char_count, char_count AS chars, 1 AS docs, 0 AS group_id FROM d WHERE i = 1
      UNION ALL
      SELECT d.key, d.i, d.doc_id, d.char_count,
             CASE WHEN is_full THEN d.char_count ELSE w.chars + d.char_count END,
             CASE WHEN is_full THEN 1 ELSE w.docs + 1 END,
             w.group_id + CASE WHEN is_full THEN 1 ELSE 0 END
      FROM (SELECT w.*, (w.chars + n.char_count > {max_chars} OR w.docs >= {max_docs}) AS is_full
            FROM walk w JOIN d n ON n.key = w.key AND n.i = w.i + 1) w
      JOIN d ON d.key = w.key AND d.i = w.i + 1)"""


@check(
    "pack",
    sql_pack(20_000, 12, "''")
    + " SELECT doc_id, char_count, CAST(group_id AS BIGINT) AS group_id FROM walk",
)
def _(spark, folder):
    """The whole corpus as one sequential walk, cut into slices."""
    docs = table(spark, folder, "documents").select("doc_id", F.col("n_chars").alias("char_count"))
    return pack_documents(docs, max_chars=20_000, max_docs=12)


@check(
    "pack_by_lang",
    sql_pack(50_000, 40, "lang")
    + " SELECT key AS lang, doc_id, char_count, CAST(group_id AS BIGINT) AS group_id FROM walk",
)
def _(spark, folder):
    docs = table(spark, folder, "documents").select(
        "lang", "doc_id", F.col("n_chars").alias("char_count")
    )
    return pack_documents(docs, max_chars=50_000, max_docs=40, key_col="lang")


# -- the store end to end ------------------------------------------------------------------


@check(
    "store_tokens",
    f"""WITH tok AS ({sql_tokens()})
    SELECT CAST(doc_id AS VARCHAR) AS original_id, string_agg(word, ' ' ORDER BY token_id) AS text
    FROM tok WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)
       OR doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND quality = 1) GROUP BY doc_id""",
)
def _(spark, folder):
    """Register, tokenize, reset some, tokenize part of these again, read."""
    from kotonoha.operators.reader import tokens_to_text

    store = CorpusStore(spark, scratch(spark, "store"))
    store.register_content(documents(spark, folder), "doc_id", "text", order_col="doc_id")
    store.tokenize()
    registry = store.documents().select("doc_id", F.col("rel_path").cast("long").alias("original"))
    toxic = table(spark, folder, "labels").where("toxic = 1").select(
        F.col("doc_id").alias("original"), "quality"
    )
    hit = registry.join(toxic, "original")
    store.reset_tokens(hit)
    store.tokenize(doc_ids=hit.where("quality = 1"))
    texts = tokens_to_text(store.tokens())
    return texts.join(registry, "doc_id").select(
        F.col("original").cast("string").alias("original_id"), "text"
    )


@check(
    "status_snapshot",
    """WITH gone AS (SELECT doc_id FROM labels WHERE toxic = 1 AND quality <> 1)
    SELECT CAST(doc_id AS VARCHAR) AS original_id, doc_id NOT IN (FROM gone) AS readable,
           doc_id NOT IN (FROM gone) AND doc_id % 10 <> 0 AS tokenize_ok
    FROM documents WHERE text IS NOT NULL""",
)
def _(spark, folder):
    """Views from a folded state and newer runs: resets, runs on listed documents, changed texts."""
    store = CorpusStore(spark, scratch(spark, "snapshot-store"))
    source = documents(spark, folder)
    store.register_content(source, "doc_id", "text", order_col="doc_id")
    store.tokenize()
    store.snapshot()
    names = store.documents().select("doc_id", F.col("rel_path").alias("original_id"))
    toxic = table(spark, folder, "labels").where("toxic = 1").select(
        F.col("doc_id").cast("string").alias("original_id"), "quality"
    )
    hit = names.join(toxic, "original_id")
    store.reset_tokens(hit)
    store.tokenize(doc_ids=hit.where("quality = 1"))
    store.snapshot()
    changed = source.where("doc_id % 10 = 0").withColumn("text", F.concat("text", F.lit(" more")))
    store.register_content(changed, "doc_id", "text", order_col="doc_id")
    read = store.token_lists().select("doc_id", F.lit(True).alias("readable"))
    state = store.tokenize_status().select("doc_id", "tokenize_ok").join(read, "doc_id", "left")
    return state.join(names, "doc_id").select(
        "original_id", F.coalesce("readable", F.lit(False)).alias("readable"), "tokenize_ok"
    )


@check(
    "store_derived",
    with_tokens("SELECT word, count(*) AS count FROM tok WHERE pos = 'word' GROUP BY word"),
)
def _(spark, folder):
    """A derived work of a store, read through its word lists."""
    from kotonoha.operators.filters import filter_tokens

    store = CorpusStore(spark, scratch(spark, "store"))
    store.register_content(documents(spark, folder), "doc_id", "text", order_col="doc_id")
    store.tokenize()
    derived = store.derive("words", lambda t: filter_tokens(t, pos_keep="word"))
    words = derived.word_lists().select(F.explode("words").alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


@check("store_derived_lists", ORACLES["store_derived"])
def _(spark, folder):
    """The same with a rule on the stored lists: no token is regrouped."""
    store = CorpusStore(spark, scratch(spark, "store"))
    store.register_content(documents(spark, folder), "doc_id", "text", order_col="doc_id")
    store.tokenize()
    derived = store.derive("words", lambda rows: filter_lists(rows, pos_keep="word"), lists=True)
    words = derived.word_lists().select(F.explode("words").alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


# -- files from end to end ------------------------------------------------------------


def _write_pages(spark, folder) -> str:
    """Every page as a file: hidden and underscore names, subfolders, empty and broken ones."""
    top = scratch(spark, "files")
    number = F.col("page_id").cast("string")
    last = F.col("page_id") % 10
    name = (
        F.when(last == 0, F.concat(F.lit("_p"), number))
        .when(last == 1, F.concat(F.lit(".p"), number))
        .when(last == 2, F.concat(F.lit("sub/_d/p"), number))
        .otherwise(F.concat(F.lit("p"), number))
    )
    content = (
        F.when(last == 3, F.lit(b""))
        .when(last == 4, F.unhex(F.lit("636166E9")))
        .otherwise(F.col("html").cast("binary"))
    )
    files = table(spark, folder, "pages").select(
        F.concat(name, F.lit(".txt")).alias("name"), content.alias("content")
    )

    _on_files(files, top, _write_file)
    return top


def _write_file(system, path, content):
    system.create_dir(path.rpartition("/")[0])
    with system.open_output_stream(path) as stream:
        stream.write(content)


def _remove_file(system, path, content):
    system.delete_file(path)


def _on_files(files, top, act) -> None:
    """One action per ``[name, content]`` row, on the workers."""

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                act(*pafs.FileSystem.from_uri(re.sub("^file:/+", "file:///", f"{top}/{name}")), content)
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    files.mapInArrow(run, "n long").agg(F.sum("n")).collect()


_FILES = """SELECT (CASE page_id % 10 WHEN 0 THEN '_p' WHEN 1 THEN '.p' WHEN 2 THEN 'sub/_d/p' ELSE 'p' END) || page_id || '.txt' AS rel_path,
                   CASE page_id % 10 WHEN 3 THEN '' WHEN 4 THEN {} ELSE html END AS text, {} AS failed FROM pages"""


def _files_read(store):
    state = store.fetch_status().select("doc_id", F.col("error_message").isNotNull().alias("failed"))
    documents = store.documents().select("doc_id", "rel_path").join(state, "doc_id")
    return documents.join(store.texts(), "doc_id", "left").select("rel_path", "text", "failed")


@check("ingest_files", _FILES.format("NULL", "page_id % 10 = 4"))
def _(spark, folder):
    """Register and read files of every kind of name, empty and broken ones among them."""
    top = _write_pages(spark, folder)
    store = CorpusStore(spark, scratch(spark, "file-store"))
    store.register_files(top)
    store.ingest()
    return _files_read(store)


@check(
    "process_files",
    """SELECT (CASE page_id % 10 WHEN 0 THEN '_p' WHEN 1 THEN '.p' WHEN 2 THEN 'sub/_d/p' ELSE 'p' END) || page_id || '.txt' AS rel_path,
              CASE WHEN page_id % 10 IN (4, 7) THEN NULL WHEN page_id % 10 = 3 THEN ''
                   WHEN page_id % 10 = 5 THEN 'changed ' || page_id ELSE html END AS text,
              page_id % 10 IN (4, 7) AS failed, page_id % 10 NOT IN (4, 7) AS tokenized FROM pages""",
)
def _(spark, folder):
    """Ingest and tokenize twice: files vanish before and after they are read, others change or are broken."""
    top = _write_pages(spark, folder)
    store = CorpusStore(spark, scratch(spark, "process-store"))
    store.register_files(top)
    number = F.col("page_id").cast("string")
    page = table(spark, folder, "pages").select("page_id", F.concat(F.lit("p"), number, F.lit(".txt")).alias("name"))

    def some(last):
        text = F.concat(F.lit("changed "), number).cast("binary").alias("content")
        return page.where(F.col("page_id") % 10 == last).select("name", text)

    _on_files(some(7), top, _remove_file)
    store.process()
    time.sleep(1.5)  # a change counts from a second after the reading on
    _on_files(some(5), top, _write_file)
    _on_files(some(6), top, _remove_file)
    store.process()
    state = store.tokenize_status().select("doc_id", F.col("tokenize_ok").alias("tokenized"))
    names = store.documents().select("doc_id", "rel_path").join(state, "doc_id")
    return _files_read(store).join(names.drop("doc_id"), "rel_path")


@check("redecode_store", _FILES.format("'caf' || chr(233)", "false"))
def _(spark, folder):
    """The broken ones read again in their own charset; registering twice changes nothing."""
    top = _write_pages(spark, folder)
    store = CorpusStore(spark, scratch(spark, "redecode-store"))
    store.register_files(top)
    store.process(fetch_only=True)
    store.register_files(top)
    store.redecode_failed("latin-1")
    return _files_read(store)


@check(
    "derived_foreign",
    with_tokens(
        """SELECT doc_id, 'ok' AS problem, CAST(count(*) AS BIGINT) AS n FROM tok WHERE word <> 'the' AND word <> 'of' GROUP BY doc_id
           UNION ALL SELECT NULL, 'null_key', count(*) FROM tok WHERE word = 'the' HAVING count(*) > 0
           UNION ALL SELECT -1, 'foreign_doc', count(*) FROM tok WHERE word = 'of' HAVING count(*) > 0"""
    ),
)
def _(spark, folder):
    """A transform that moves tokens to no and to an unknown document: both are reported."""
    store = CorpusStore(spark, scratch(spark, "foreign-store"))
    store.register_content(documents(spark, folder), "doc_id", "text", order_col="doc_id")
    store.tokenize()
    word = F.col("word")
    moved = F.when(word == "the", F.lit(None)).when(word == "of", F.lit(-1)).otherwise(F.col("doc_id"))
    derived = store.derive("foreign", lambda tokens: tokens.withColumn("doc_id", moved))
    names = store.documents().select("doc_id", F.col("rel_path").cast("long").alias("_own"))
    kept = derived.token_lists().where(F.size("tokens") > 0).join(names, "doc_id").select(
        F.col("_own").alias("doc_id"), F.lit("ok").alias("problem"), F.size("tokens").cast("long").alias("n")
    )
    return kept.unionByName(derived.problems)
