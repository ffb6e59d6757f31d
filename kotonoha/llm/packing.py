"""Order-preserving packing of token streams by dynamic programming.

Documents follow one another in the order in which the table stores them. A
sequence is a stretch of that stream of at most ``window`` tokens. Cuts lie at
ends of documents, which are free, or at ends of sentences, which cost
``cut_penalty`` tokens; inside a sentence only where the sentence alone is
longer than RUN_ON, at twice the price. Among all such cuts those are taken that make padding
plus penalties smallest:

    cost(j) = min over i, end(j) - end(i) <= window, of
              cost(i) + window - (end(j) - end(i)) + penalty(j)

The part that depends on i is cost(i) + end(i), so its minimum over the sliding
window comes from a monotone queue in constant time per boundary.

Spark deals out the work: each input split is packed by itself, in storage
order, so neither texts nor token ids are shuffled and a lost task repeats the
same splits with the same result. A split ends with one padded sequence. Inside
a split the program runs over blocks; the last sequence of a block stays open
and is packed again with the next block, so blocks leave no seam.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
import zlib
from array import array
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kotonoha.llm.bpe import BpeFile, merge_loop
from kotonoha.llm.common import column, slices

WINDOW = 2048
CUT_PENALTY = 12
# Tokens that are packed together before their cuts are fixed.
BLOCK_TOKENS = 256 * WINDOW
# Distinct space-free chunks whose ids a worker remembers; beyond it, it starts anew.
CACHE_CHUNKS = 800_000
# Characters of texts that are split and looked up together; a longer text is by itself.
GROUP_CHARACTERS = 500_000

# Longest stretch without a sentence's end that stays whole.
RUN_ON = 128

# Kind of a boundary: end of a document, end of a sentence, forced.
DOCUMENT, SENTENCE, FORCED = 0, 1, 2

# Last characters of a chunk that end a sentence.
_STOPS = frozenset(".!?…。！？")
# Stands at a word's end while new chunks are merged; a text that holds it takes the other way.
_WORD_END = "\x01"
# Letters whose lower case depends on what is around them, and the mark above.
_ODD = frozenset("\u0130\u03a3" + _WORD_END)
# Characters that this old table has are classed alike by all libraries; later ones may not be.
_SETTLED = unicodedata.ucd_3_2_0
# Fixed value: the split of the vocabulary file, with line ends between chunks.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+|\n"
_WORDS = regex.compile(_SPLIT)
_ASCII_WORDS = re.compile(
    _SPLIT.replace(r"[\p{L}]", "[a-z]").replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9"), re.ASCII
)
_PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class ChunkEncoder:
    """Token ids of texts through a `tokenizers` file, remembered per space-free chunk.

    Only for a tokenizer that lower-cases, drops white space, and whose merges
    cross neither white space nor the end of a run of letters. New chunks of many
    texts are lower-cased, split and merged together; chunks with a character
    whose treatment depends on the library go to the tokenizer one by one.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        ranks = BpeFile(path).ranks(word_end=_WORD_END.encode())
        self._merges = merge_loop(ranks, rf"[^\s{_WORD_END}]+{_WORD_END}|\n")
        self._line_id = ranks[b"\n"]
        # Chunk -> its ids as little-endian 32-bit words.
        self._known: dict[str, bytes] = {}
        self._stops = np.zeros(self._tokenizer.get_vocab_size(), bool)
        for mark in _STOPS:
            self._stops[self._tokenizer.encode(mark, add_special_tokens=False).ids[-1:]] = True

    def _learn(self, chunks: list[str]) -> None:
        """Ids of new chunks, none of which holds a line end."""
        joined = "\n".join(chunks)
        odd = {c for c in set(joined) if c in _ODD or (c > "\x7f" and _SETTLED.category(c) == "Cn")}
        if odd or "<|" in joined:
            plain = []
            for chunk in chunks:
                if "<|" in chunk or not odd.isdisjoint(chunk):
                    ids = self._tokenizer.encode(chunk, add_special_tokens=False).ids
                    self._known[chunk] = array("I", ids).tobytes()
                else:
                    plain.append(chunk)
            if not plain:
                return
            chunks, joined = plain, "\n".join(plain)
        if joined.isascii():
            words = _ASCII_WORDS.findall(joined.lower())
        else:
            words = _WORDS.findall(unicodedata.normalize("NFC", joined).lower())
        words.append("\n")
        ids = self._merges.encode_to_numpy(_WORD_END.join(words)).astype("<u4", copy=False)
        ends = np.flatnonzero(ids == self._line_id) * 4
        held = ids.tobytes()
        begins = [0, *(ends[:-1] + 4).tolist()]
        self._known.update(
            (c, held[i:j]) for c, i, j in zip(chunks, begins, ends.tolist(), strict=True)
        )

    def encode_many(self, texts: list[str]) -> list[tuple[np.ndarray, list[int]]]:
        """For each text its ids and the token counts after which a sentence ends."""
        joined = "\n".join(texts)
        chunks = joined.replace("\n", " ").split(" ")
        line_ends = np.cumsum([line.count(" ") + 1 for line in joined.split("\n")]) - 1
        if len(self._known) > CACHE_CHUNKS:
            self._known.clear()
        rows = list(map(self._known.get, chunks))
        if None in rows:
            self._learn(list({c: 0 for c, r in zip(chunks, rows, strict=True) if r is None}))
            rows = list(map(self._known.__getitem__, chunks))
        ids = np.frombuffer(b"".join(rows), "<u4")
        ends = np.cumsum(np.fromiter(map(len, rows), np.int64, len(rows))) >> 2
        stops = np.zeros(len(ids) + 1, bool)
        stops[1:] = self._stops[ids]
        found = stops[ends]  # the last id of the chunk, or of the one before an empty chunk
        found[line_ends] = True
        stops = ends[found]
        places = np.cumsum([t.count(" ") + t.count("\n") + 1 for t in texts]) - 1
        bounds = [0, *ends[places].tolist()]
        first = [0, *(np.cumsum(found)[places]).tolist()]
        return [
            (ids[i:j], (stops[a:b] - i).tolist())
            for i, j, a, b in zip(bounds, bounds[1:], first, first[1:], strict=False)
        ]

    def encode(self, text: str) -> tuple[np.ndarray, list[int]]:
        return self.encode_many([text])[0]


def groups_of_texts(texts: list[str | None], characters: int = GROUP_CHARACTERS) -> Iterator[list[str]]:
    """The texts in order in groups of about so many characters; a missing one is empty."""
    group, size = [], 0
    for text in texts:
        group.append(text or "")
        size += len(group[-1])
        if size >= characters:
            yield group
            group, size = [], 0
    if group:
        yield group


def boundaries(sentence_ends: list[int], length: int, window: int) -> list[tuple[int, int]]:
    """(position, kind) of the places in one document where a cut may lie.

    Text that runs on without a sentence's end may also be cut, at the highest
    price, after each stretch of an eighth of a window at most.
    """
    found = []
    last = 0
    stretch = max(1, min(RUN_ON, window // 8))
    for end in [*sentence_ends, length]:
        if end <= last:
            continue
        while end - last > stretch:
            last += stretch
            found.append((last, FORCED))
        if end < length:
            found.append((end, SENTENCE))
        last = end
    found.append((length, DOCUMENT))
    return found


def best_cuts(ends: list[int], kinds: list[int], window: int, penalty: int) -> list[int]:
    """Indexes of the chosen boundaries; the last one is always chosen.

    ``ends`` grows, starts above 0 and has no gap above ``window``.
    """
    price = (0, penalty, 2 * penalty)
    cost = [0] * (len(ends) + 1)
    back = [0] * (len(ends) + 1)
    place = [0, *ends]
    queue = deque([0])  # indexes with growing cost + place
    for j in range(1, len(place)):
        here = place[j]
        while here - place[queue[0]] > window:
            queue.popleft()
        i = queue[0]
        back[j] = i
        cost[j] = cost[i] + place[i] + window - here + price[kinds[j - 1]]
        value = cost[j] + here
        while queue and cost[queue[-1]] + place[queue[-1]] > value:
            queue.pop()
        queue.append(j)
    chosen = []
    j = len(ends)
    while j:
        chosen.append(j - 1)
        j = back[j]
    return chosen[::-1]


class _Packer:
    """Packs the documents of one split, given in order."""

    def __init__(self, window: int, penalty: int, first_sequence: int):
        self.window, self.penalty = window, penalty
        self.sequence = first_sequence
        # Open documents: id, ids not yet packed, tokens before them, all tokens.
        self.waiting: deque = deque()
        self.ends: list[int] = []
        self.kinds: list[int] = []
        self.tokens = 0

    def add(self, key, ids: np.ndarray, sentence_ends: list[int]) -> Iterator[tuple]:
        self.waiting.append([key, ids, 0, len(ids)])
        base = self.tokens
        for place, kind in boundaries(sentence_ends, len(ids), self.window):
            self.ends.append(base + place)
            self.kinds.append(kind)
        self.tokens += len(ids)
        if self.tokens >= BLOCK_TOKENS:
            yield from self.flush(final=False)

    def flush(self, final: bool = True) -> Iterator[tuple]:
        if not self.ends:
            return
        chosen = best_cuts(self.ends, self.kinds, self.window, self.penalty)
        if not final:
            chosen = chosen[:-1]
        start = 0
        for index in chosen:
            yield from self._sequence(self.ends[index] - start)
            start = self.ends[index]
        if chosen:
            keep = chosen[-1] + 1
            self.ends = [e - start for e in self.ends[keep:]]
            self.kinds = self.kinds[keep:]
            self.tokens -= start

    def _sequence(self, room: int) -> Iterator[tuple]:
        offset = 0
        while room:
            key, ids, before, total = front = self.waiting[0]
            n = min(room, len(ids))
            crc = zlib.crc32(ids[:n].astype("<u4", copy=False).tobytes())
            yield key, before, n, crc, total, self.sequence, offset
            if n == len(ids):
                self.waiting.popleft()
            else:
                front[1], front[2] = ids[n:], before + n
            offset += n
            room -= n
        self.sequence += 1


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    end_id: int = 1,
    window: int = WINDOW,
    cut_penalty: int = CUT_PENALTY,
    id_col: str = "doc_id",
    text_col: str = "text",
    build: Callable[[str], ChunkEncoder] = ChunkEncoder,
) -> DataFrame:
    """Pieces of documents in sequences of at most ``window`` tokens.

    One row per piece: the id, ``start`` and ``length`` in tokens, ``ids_crc32``
    of its ids, ``doc_tokens``, ``sequence_id`` and ``offset`` inside the
    sequence. A document is its ids and then ``end_id``; a missing or empty text
    is that one id. Ids may be missing or repeated: every row is packed by
    itself, and its pieces follow each other. Columns other than id and text are
    not read. An empty table gives no rows. Sequences are numbered per input
    split (split number times 2^33 plus place), so numbers are unique, not
    gapless.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    source = docs.select(
        F.col(id_col).alias("_id"),
        F.col(text_col).cast("string").alias("_text"),
        F.spark_partition_id().alias("_split"),
    )

    def run(batches):
        encoder = packer = None
        arrow_id = None

        def rows(found):
            cols = list(zip(*found, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], arrow_id), *[pa.array(c, pa.int64()) for c in cols[1:]]],
                names=["_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

        for batch in slices(batches):
            if packer is None:
                encoder = build(tokenizer_path)
                packer = _Packer(window, cut_penalty, batch.column(2)[0].as_py() << 33)
                arrow_id = batch.schema.field(0).type
            found = []
            keys = iter(column(batch, "_id"))
            for group in groups_of_texts(column(batch, "_text")):
                for ids, stops in encoder.encode_many(group):
                    found += packer.add(next(keys), np.append(ids, np.uint32(end_id)), stops)
            if found:
                yield rows(found)
        if packer is not None and (found := list(packer.flush())):
            yield rows(found)

    return source.mapInArrow(run, f"_id {id_type}, {_PIECES}").withColumnRenamed("_id", id_col)
