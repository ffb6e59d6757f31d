"""Alignment of two tokenizers over the bytes of the same texts.

Both tokenizations of a text end at byte offsets that only grow. Where both end,
the text is cut into groups; the ends they share are found by galloping: every
entry of the shorter list is looked up in the longer one by exponential steps
from where an earlier entry was found, then by halving. Entries are looked up
coarse to fine, each from its neighbour on the level above, so a whole batch of
texts takes part in one search. The places found are ranks in the other list,
and differences of ranks are the ranges of tokens that overlap a token.

How often a pair of ids is linked over the whole corpus needs all texts. Links
are therefore kept in blocks of many documents: a block has its distinct pairs
with their counts, and for each document the ranks of its pairs in that list.
Spark sums the counts of pairs over the blocks, finds the highest count of each
second id, and sends the totals back to the blocks, where they are added up per
document. Neither links nor texts are shuffled one by one, and a pair that
occurs everywhere is one row per block.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kotonoha.llm.bpe import ByteLevelBpe
from kotonoha.llm.common import column, slices
from kotonoha.plans.layout import cut_lineage

# Links of a block; one document with more of them is a block of its own.
BLOCK_LINKS = 3_000_000
# Characters of texts that are aligned together; a longer text is by itself.
GROUP_CHARACTERS = 1_000_000
# A longer text is given to sentencepiece in parts of about this many characters.
PART_CHARACTERS = 50_000
# Distinct words whose ids a worker remembers; beyond it, it starts anew.
KNOWN_WORDS = 800_000
SPACE_MARK = "▁"

_TOKENS = ("n_a", "n_b", "n_groups", "n_links")


class PieceEncoder:
    """Ids of texts through a sentencepiece file that adds a space in front.

    Where no piece goes on behind a space, no merge crosses into one, and a text
    with single spaces is the sum of its words; their ids are remembered.
    """

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self._model.id_to_piece(i) for i in range(self._model.get_piece_size())]
        self.token_bytes = [
            bytes([int(p[3:5], 16)]) if self._model.is_byte(i) else p.replace(SPACE_MARK, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self._cuts = not any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in pieces)
        self._opens = np.array([p.startswith(SPACE_MARK) for p in pieces])
        # Word -> its ids as little-endian 32-bit words; words that do not come back.
        self._known: dict[str, bytes] = {}
        self._lost: set[str] = set()

    def _parts(self, text: str) -> Iterator[str]:
        """Parts that are encoded alike alone: each but the first lost the space in front of it."""
        start = 0
        while self._cuts and len(text) - start > PART_CHARACTERS:
            cut = text.find(" ", start + PART_CHARACTERS)
            while cut > 0 and text[cut - 1] in (" ", SPACE_MARK):
                cut = text.find(" ", cut + 1)
            if cut < 0:
                break
            yield text[start:cut]
            start = cut + 1
        yield text[start:]

    def _comes_back(self, text: str, ids: list[int]) -> bool:
        whole = (" " + text).encode("utf-8", "surrogatepass")
        return b"".join(map(self.token_bytes.__getitem__, ids)) == whole

    def _learn(self, words: list[str]) -> None:
        """Ids of new words from one text of them, in which every word starts with a space."""
        text = " ".join(words)
        ids = [x for part in self._parts(text) for x in self._model.encode(part)]
        if not self._comes_back(text, ids):
            for word in words:
                ids = self._model.encode(word)
                self._known[word] = array("I", ids).tobytes()
                if not self._comes_back(word, ids):
                    self._lost.add(word)
            return
        ids = np.array(ids, "<u4")
        begins = np.flatnonzero(self._opens[ids]) * 4
        held, ends = ids.tobytes(), [*begins[1:].tolist(), 4 * len(ids)]
        self._known.update((w, held[i:j]) for w, i, j in zip(words, begins.tolist(), ends, strict=True))

    def encode(self, text: str) -> np.ndarray | None:
        """Ids of the text; None where they do not give back a space and the text."""
        if not self._cuts or "  " in text or SPACE_MARK in text or text[0] == " " or text[-1] == " ":
            ids = [x for part in self._parts(text) for x in self._model.encode(part)]
            return np.array(ids, np.int64) if self._comes_back(text, ids) else None
        if len(self._known) > KNOWN_WORDS:
            self._known.clear()
            self._lost.clear()
        words = text.split(" ")
        rows = list(map(self._known.get, words))
        if None in rows:
            self._learn([w for w, r in {w: r for w, r in zip(words, rows, strict=True)}.items() if r is None])
            rows = list(map(self._known.__getitem__, words))
        if self._lost and not self._lost.isdisjoint(words):
            return None
        return np.frombuffer(b"".join(rows), "<u4").astype(np.int64)


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each entry of ``short`` the first place in ``long`` with no smaller value.

    Both grow strictly and ``long`` has an entry of at least ``short[-1]``.
    """
    n, last = len(short), len(long) - 1
    places = np.zeros(n, np.int64)
    if not n:
        return places
    stride = 1 << (n - 1).bit_length()
    entries = np.zeros(1, np.int64)  # the first entry starts at the first place
    begin = np.zeros(1, np.int64)
    while True:
        target = short[entries]
        # Everything before ``begin`` is smaller than the target.
        found = begin.copy()
        live = np.flatnonzero(long[begin] < target)
        low = begin[live]
        step = 1
        waiting, floor = [], []
        ceiling = []
        while len(live):
            high = np.minimum(low + step, last)
            below = long[high] < target[live]
            waiting.append(live[~below])
            floor.append(low[~below])
            ceiling.append(high[~below])
            live, low = live[below], high[below]
            step *= 2
        if waiting:
            live, low, high = map(np.concatenate, (waiting, floor, ceiling))
            found[live] = high
            # long[low] < target <= long[high]
            open_ = np.flatnonzero(high - low > 1)
            live, low, high = live[open_], low[open_], high[open_]
            while len(live):
                middle = (low + high) >> 1
                below = long[middle] < target[live]
                low = np.where(below, middle, low)
                high = np.where(below, high, middle)
                found[live] = high
                open_ = high - low > 1
                live, low, high = live[open_], low[open_], high[open_]
        places[entries] = found
        stride >>= 1
        if not stride:
            return places
        entries = np.arange(stride, n, 2 * stride)
        begin = places[entries - stride]


def overlaps(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, behind, shared): the tokens of ``long`` that overlap each token of ``short``.

    ``first`` and ``behind`` bound the range, ``shared`` says whether both end there.
    """
    place = gallop(short, long)
    shared = long[place] == short
    first = np.zeros(len(short), np.int64)
    first[1:] = place[:-1] + shared[:-1]
    return first, place + 1, shared


def spread_ranges(first: np.ndarray, behind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, member) for all members of the ranges, in order."""
    sizes = behind - first
    rows = np.repeat(np.arange(len(sizes)), sizes)
    members = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[rows]
    return rows, members


class Aligner:
    """Both tokenizers of a worker and the alignment of groups of texts."""

    def __init__(self, path_a: str, path_b: str):
        self._a = ByteLevelBpe(path_a, specials=False)
        self._b = PieceEncoder(path_b)
        words_a = [self._a.token_bytes.get(i, b"") for i in range(max(self._a.token_bytes) + 1)]
        self._sizes = tuple(np.array(list(map(len, w)), np.int64) for w in (words_a, self._b.token_bytes))
        # Decimal id and what follows it in a list of groups: the same side, the other,
        # the next group. A's ids count from the front, B's from the back.
        marks_a, marks_b = (
            [f"{i}{mark}".encode() for i in range(len(sizes)) for mark in marks]
            for sizes, marks in zip(self._sizes, (",|", ",;"), strict=True)
        )
        self._marks = marks_a + marks_b[::-1]

    def tokens(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both sides; None where either does not give back the bytes of the text."""
        found = []
        for text in texts:
            pieces = self._b.encode(text) if text else None
            if pieces is None:
                found.append(None)
                continue
            # Byte-level tokens cover the bytes that they are given; their number tells.
            ids = self._a.encode(" " + text).astype(np.int64)
            same = self._sizes[0][ids].sum() == self._sizes[1][pieces].sum()
            found.append((ids, pieces) if same else None)
        return found

    def align(self, texts: list[str]) -> tuple[dict[str, list], np.ndarray, np.ndarray]:
        """Counts and digest of each text, then (text, pair) of every link; pair is a << 32 | b."""
        outputs = {n: [0] * len(texts) for n in _TOKENS} | {"groups_sha256": [""] * len(texts)}
        rows, pairs = [], []
        tokens = self.tokens(texts)
        for a_leads in (True, False):
            chosen = [i for i, t in enumerate(tokens) if t and (len(t[0]) <= len(t[1])) == a_leads]
            if chosen:
                row, pair = self._align(chosen, [tokens[i] for i in chosen], a_leads, outputs)
                rows.append(row)
                pairs.append(pair)
        if not rows:
            return outputs, np.zeros(0, np.int64), np.zeros(0, np.int64)
        return outputs, np.concatenate(rows), np.concatenate(pairs)

    def _align(self, chosen: list[int], tokens: list, a_leads: bool, outputs: dict) -> tuple:
        ids = [np.concatenate([t[side] for t in tokens]) for side in (0, 1)]
        # One text's tokens end where the next one's begin, on both sides at the same byte.
        ends = [np.cumsum(self._sizes[side][ids[side]]) for side in (0, 1)]
        counts = [np.array([len(t[side]) for t in tokens], np.int64) for side in (0, 1)]
        bounds = [np.concatenate([[0], np.cumsum(c)]) for c in counts]
        lead, other = (0, 1) if a_leads else (1, 0)
        first, behind, shared = overlaps(ends[lead], ends[other])
        leaders, members = spread_ranges(first, behind)
        pair = (ids[lead][leaders] << 32 | ids[other][members]) if a_leads else (ids[other][members] << 32 | ids[lead][leaders])
        text_of = np.repeat(np.arange(len(chosen)), counts[lead])
        links = np.bincount(text_of, behind - first, len(chosen)).astype(np.int64)
        groups = np.bincount(text_of, shared, len(chosen)).astype(np.int64)
        # Last token of every group, on either side.
        group_ends = [None, None]
        group_ends[lead] = np.flatnonzero(shared)
        group_ends[other] = behind[shared] - 1
        lists = self._lists(ids, group_ends, bounds)
        for name, values in zip(_TOKENS, (*counts, groups, links), strict=True):
            for i, value in zip(chosen, values.tolist(), strict=True):
                outputs[name][i] = value
        for i, value in zip(chosen, lists, strict=True):
            outputs["groups_sha256"][i] = value
        return np.asarray(chosen)[text_of[leaders]], pair

    def _lists(self, ids: list, group_ends: list, bounds: list) -> Iterator[str]:
        """Digest of each text's groups, written as a1,a2|b1;a3|b2,b3."""
        size = [np.diff(e, prepend=-1) for e in group_ends]
        n_groups = len(size[0])
        order = np.empty(len(ids[0]) + len(ids[1]), np.int64)
        for side in (0, 1):
            last = np.zeros(len(ids[side]), np.int64)
            last[group_ends[side]] = 1
            group = np.repeat(np.arange(n_groups), size[side])
            # Tokens of the other side that stand before: of earlier groups, and A before B.
            ahead = np.cumsum(size[1 - side]) - (size[1] if side == 0 else 0)
            # Codes of the second side are negative, counted from -1.
            code = 2 * ids[side] + last
            order[np.arange(len(code)) + ahead[group]] = code if side == 0 else -1 - code
        starts = (bounds[0] + bounds[1]).tolist()
        for i, j in zip(starts, starts[1:], strict=False):
            part = order[i:j].tolist()
            text = b"".join(map(self._marks.__getitem__, part))
            yield hashlib.sha256(text[:-1]).hexdigest()


def pack_ranks(rows: np.ndarray, ranks: np.ndarray, documents: int) -> tuple[bytes, np.ndarray]:
    """Ranks of every document in growing order as compressed steps, and where documents end."""
    width = int(ranks.max(initial=0)) + 1
    steps = np.diff(np.sort(rows * width + ranks) % width, prepend=0).astype("<i4")
    # Like bytes together: most steps are short.
    planes = steps.view(np.uint8).reshape(-1, 4).T.tobytes()
    ends = np.cumsum(np.bincount(rows, minlength=documents))
    return pa.compress(planes, "zstd", asbytes=True), ends


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values in order, the rank of each given one, how often each stands there)."""
    codes, found = pd.factorize(values)
    order = np.argsort(found)
    ranks = np.empty(len(found), np.int64)
    ranks[order] = np.arange(len(found))
    return found[order], ranks[codes], np.bincount(codes, minlength=len(found))[order]


def unpack_ranks(held: bytes, n: int) -> np.ndarray:
    planes = pa.decompress(held, 4 * n, "zstd", asbytes=True)
    steps = np.frombuffer(planes, np.uint8).reshape(4, -1).T.copy().view("<i4")
    return np.cumsum(steps.ravel(), dtype=np.int64)


def _blocks(docs: DataFrame, path_a: str, path_b: str, id_col: str, text_col: str) -> DataFrame:
    """One row per block of documents: their counts, the block's distinct pairs, packed ranks."""
    id_field = docs.schema[id_col].dataType.simpleString()
    source = docs.select(
        F.col(id_col).alias("_id"),
        F.col(text_col).cast("string").alias("_text"),
        F.spark_partition_id().alias("_split"),
    )
    counts = ", ".join(f"{n} array<long>" for n in _TOKENS)
    schema = (
        f"block long, ids array<{id_field}>, {counts}, groups_sha256 array<string>,"
        " ends array<long>, ranks binary, pairs array<long>, times array<long>"
    )

    def run(batches):
        aligner, block = None, 0
        ids, outputs, rows, pairs = [], {}, [], []
        n_docs = n_links = 0

        def flush():
            nonlocal n_docs, n_links
            found, ranks, times = distinct(np.concatenate(pairs))
            held, ends = pack_ranks(np.concatenate(rows), ranks, n_docs)
            lists = {
                "ids": pa.concat_arrays(ids),
                **{n: pa.array(v, pa.string() if n == "groups_sha256" else pa.int64()) for n, v in outputs.items()},
                "ends": pa.array(ends, pa.int64()),
            }
            after = {"pairs": pa.array(found, pa.int64()), "times": pa.array(times, pa.int64())}

            def one(values):
                return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

            names = ["block", *lists, "ranks", *after]
            row = [pa.array([block], pa.int64()), *map(one, lists.values()), pa.array([held], pa.binary()), *map(one, after.values())]
            for some in (ids, rows, pairs):
                some.clear()
            outputs.clear()
            n_docs = n_links = 0
            return pa.RecordBatch.from_arrays(row, names=names)

        for batch in slices(batches):
            if aligner is None:
                aligner = Aligner(path_a, path_b)
                block = batch.column(2)[0].as_py() << 33
            texts = [t or "" for t in column(batch, "_text")]
            start = 0
            while start < len(texts):
                stop, size = start, 0
                while stop < len(texts) and (stop == start or size + len(texts[stop]) <= GROUP_CHARACTERS):
                    size += len(texts[stop])
                    stop += 1
                found, row, pair = aligner.align(texts[start:stop])
                if n_docs and n_links + len(pair) > BLOCK_LINKS:
                    yield flush()
                    block += 1
                ids.append(batch.column(0).slice(start, stop - start))
                for name, values in found.items():
                    outputs.setdefault(name, []).extend(values)
                rows.append(row + n_docs)
                pairs.append(pair)
                n_docs += stop - start
                n_links += len(pair)
                start = stop
        if n_docs:
            yield flush()

    return source.mapInArrow(run, schema)


def align_tokenizers(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """How a byte-level tokenizer (A) and a sentencepiece one (B) agree on each text.

    One row per document: the id, tokens ``n_a`` and ``n_b``, ``n_groups`` between
    shared ends, ``n_links`` pairs of overlapping tokens, ``n_best`` links whose
    pair of ids is linked as often in the corpus as any pair with its B id,
    ``count_sum`` of these corpus-wide counts over the links, and
    ``groups_sha256`` of the groups in the form ``a1,a2|b1;a3|b2,b3``. A reads a
    space and the text, B adds the space itself; special tokens are not known.
    Texts that are missing, empty, or not given back byte for byte by both have
    zeros and an empty digest. Ids may be missing or repeated: every row counts by
    itself. Columns other than id and text are not read. An empty table gives no rows.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    blocks = cut_lineage(_blocks(docs, path_a, path_b, id_col, text_col))
    linked = blocks.select("block", F.explode(F.arrays_zip("pairs", "times")).alias("_l")).select(
        "block", F.col("_l.pairs").alias("pair"), F.col("_l.times").alias("times")
    )
    totals = linked.groupBy("pair").agg(F.sum("times").alias("total"))
    b_id = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    # One row per id of B's vocabulary at most.
    best = totals.groupBy(b_id.alias("_b")).agg(F.max("total").alias("_most"))
    known = (
        linked.select("block", "pair")
        .join(totals, "pair")
        .join(F.broadcast(best), b_id == F.col("_b"))
        .select(F.col("block").alias("_of"), "pair", "total", (F.col("total") == F.col("_most")).alias("best"))
    )
    held = blocks.select("block", "ids", *_TOKENS, "groups_sha256", "ends", "ranks")
    names = ["_id", *_TOKENS, "n_best", "count_sum", "groups_sha256"]

    def add_up(block: pa.Table, pairs: pa.Table) -> pa.Table:
        pairs = pairs.sort_by("pair")
        total = pairs.column("total").to_numpy()
        best = pairs.column("best").to_numpy().astype(np.int64)
        row = {n: block.column(n)[0] for n in block.column_names}
        ends = row["ends"].values.to_numpy()
        ranks = unpack_ranks(row["ranks"].as_py(), int(ends[-1]))
        sums = []
        for values in (best, total):
            before = np.concatenate([[0], np.cumsum(values[ranks])])
            sums.append(np.diff(before[ends], prepend=0))
        return pa.table(
            [row["ids"].values, *[row[n].values for n in _TOKENS], *map(pa.array, sums), row["groups_sha256"].values],
            names=names,
        )

    found = held.groupBy("block").cogroup(known.groupBy("_of")).applyInArrow(
        add_up,
        f"_id {id_type}, " + ", ".join(f"{n} long" for n in names[1:-1]) + ", groups_sha256 string",
    )
    return found.withColumnRenamed("_id", id_col)
