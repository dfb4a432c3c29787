r"""SentencePiece encoding and decoding as a max-plus parallel scan.

Of all ways to cut a text into pieces of a public vocabulary, the one with the largest sum of piece scores is
taken. A piece's score falls with the logarithm of its rank; scores are whole numbers, so sums are exact
however they are grouped. Ties go to the longer last piece.

Texts longer than ``CHUNK`` characters are split into chunks that are rows of their own. A piece may reach over a
chunk's end by fewer characters than the longest piece has; how far it does is the boundary state. Each
chunk gives a matrix: the best sum from entering in state j to leaving in state k. Matrices are combined by the
max-plus product, which is associative: a prefix scan over a document's chunks gives the state in which each
is entered and left on the best path. Then every chunk is traced back on its own, between its two states.

The vocabulary has spaces (written ``▁`` there) at the start of pieces only: no piece crosses from another
character to a space. There a text falls into words that are cut independently, and equal words once; in a matrix
only the words at a chunk's ends depend on the states. All characters outside the vocabulary, a literal ``▁`` among
them, become byte pieces, so decoding returns every text exactly.
"""

from __future__ import annotations

import itertools
import operator
from array import array
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.tables import settled

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = 32_768
SPACE, MARK = " ", "▁"  # in texts, and in the vocabulary
NEVER = -(1 << 60)  # the score of what cannot be
# A piece costs SCALE * ln(rank + FLAT); a byte piece costs as much as the rarest piece, and half again.
SCALE, FLAT = 1000, 300
# A worker's memory of words: so many bytes, and as many of older ones. Words too long to be cut side by side are not remembered.
_HELD_BYTES, _WORD_BYTES = 72_000_000, 200
_TOGETHER = 16_384  # words that are cut side by side at once
_SLICE_CHARS, _SLICE_CHUNKS = 1_000_000, 16  # what a task works on at once
_SIDE_BY_SIDE = (7, 10, 14, 40)  # words of up to so many characters are cut side by side


class Vocabulary:
    """The pieces with their scores and ids, and the ways to cut a text by them."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.pieces: dict[str, tuple[int, int]] = {}
        self.bytes = [0] * 256
        self.text: dict[int, bytes] = {}
        rank = 0
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
                self.text[i] = bytes([int(piece[1:-1], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                piece = piece.replace(MARK, SPACE)
                self.pieces[piece] = (-round(SCALE * np.log(rank + FLAT)), i)
                self.text[i] = piece.encode()
                rank += 1
        inner = [p for p in self.pieces if SPACE in p.lstrip(SPACE)]
        if inner:
            raise ValueError(f"pieces with an inner space, such as {inner[0]!r}: words are not independent")
        self.longest = max(map(len, self.pieces), default=1)
        self.byte_score = -round(1.5 * SCALE * np.log(rank + FLAT))
        self.scores = np.full(size, self.byte_score, np.int64)
        for value, i in self.pieces.values():
            self.scores[i] = value
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._held = 0

    @cached_property
    def table(self) -> dict[str, tuple[int, int] | None]:
        """The pieces, and their beginnings: those that are none themselves lead on, with nothing to add."""
        return {p[:n]: None for p in self.pieces for n in range(1, len(p))} | self.pieces

    def forward(self, text: str, start: int = 0, stop: int | None = None) -> tuple[list[int], list]:
        """Best sums from ``start`` to every position, by pieces that begin before ``stop``; and the last pieces."""
        stop = len(text) if stop is None else stop
        best = [NEVER] * (len(text) + 1)
        back: list = [None] * (len(text) + 1)
        best[start] = 0
        get, n = self.table.get, len(text)
        for i in range(start, stop):
            here = best[i]
            if here == NEVER:
                continue
            for j in range(i + 1, n + 1):
                found = get(text[i:j], 0)
                if found:
                    # Of equal sums the longer last piece: it began first, and stays.
                    total = here + found[0]
                    if total > best[j]:
                        best[j] = total
                        back[j] = (i, found[1])
                elif found == 0:
                    break
            if text[i] not in self.pieces:
                raw = text[i].encode()
                value = here + len(raw) * self.byte_score
                if value > best[i + 1]:
                    best[i + 1], back[i + 1] = value, (i, raw)
        return best, back

    def trace(self, back: list, start: int, stop: int) -> list[int]:
        """The ids on the best path from ``start`` to ``stop``."""
        out: list[int] = []
        while stop > start:
            stop, piece = back[stop]
            if isinstance(piece, int):
                out.append(piece)
            else:
                out.extend(self.bytes[b] for b in reversed(piece))
        out.reverse()
        return out

    def _remember(self, found: dict[str, bytes]) -> None:
        """The latest words are remembered: as many bytes as are held, and before them as many of older ones."""
        own = _WORD_BYTES * len(found) + sum(map(len, found)) + sum(map(len, found.values()))
        if self._held + own > _HELD_BYTES:
            self._older, self._known, self._held = self._known, {}, 0
        self._known.update(found)
        self._held += own

    def encode(self, text: str) -> list[int]:
        """A whole text, or a part of one between two cuts."""
        return np.frombuffer(self.encode_all([text])[0], np.int32).tolist()

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Whole texts, their ids as packed int32; the words that are new among them are cut side by side."""
        cut = [words(t) for t in texts]
        found = [list(map(self._known.get, ws)) for ws in cut]
        missed: set[str] = set()
        for ws, ids in zip(cut, found, strict=True):
            missed.update(itertools.compress(ws, map(operator.not_, ids)))
        # Words met again are among the latest once more.
        fresh = {w: self._older[w] for w in missed if w in self._older}
        new = [w for w in missed if w not in fresh]
        self._remember(fresh)
        fresh.update((w, array("i", self.trace(self.forward(w)[1], 0, len(w))).tobytes()) for w in new if len(w) > _SIDE_BY_SIDE[-1])
        for least, most in itertools.pairwise((0, *_SIDE_BY_SIDE)):
            alike = [w for w in new if least < len(w) <= most]
            for at in range(0, len(alike), _TOGETHER):
                some = self._cut_all(alike[at : at + _TOGETHER])
                self._remember(some)
                fresh.update(some)
        return [b"".join([x or fresh[w] for w, x in zip(ws, ids, strict=True)]) for ws, ids in zip(cut, found, strict=True)]

    @cached_property
    def _tree(self) -> tuple[np.ndarray, ...]:
        """The table as arrays: sorted edges (node, character) with the nodes they lead to, and each node's piece."""
        nodes = {p: k for k, p in enumerate(["", *sorted(self.table)])}
        edges = sorted((nodes[p[:-1]] << 21 | ord(p[-1]), k) for p, k in nodes.items() if p)
        score, ids = np.full(len(nodes), NEVER, np.int64), np.full(len(nodes), -1, np.int64)
        for p, (value, i) in self.pieces.items():
            score[nodes[p]], ids[nodes[p]] = value, i
        return np.array([e for e, _ in edges]), np.array([k for _, k in edges]), score, ids

    def _cut_all(self, texts: list[str]) -> dict[str, bytes]:
        """The packed ids of many short words: every step of the search is taken for all words at once."""
        if not texts:
            return {}
        edges, leads, score, piece = self._tree
        order = np.argsort(-np.fromiter(map(len, texts), np.int64, len(texts)), kind="stable").tolist()
        texts = [texts[k] for k in order]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        width = int(sizes[0])
        codes = np.zeros((len(texts), width), np.int64)
        flat = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        codes[np.arange(width) < sizes[:, None]] = flat
        raw = (1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)) * self.byte_score
        best = np.full((width + 1, len(texts)), NEVER, np.int64)
        back = np.zeros((width + 1, len(texts)), np.int64)
        last = np.full((width + 1, len(texts)), -1, np.int64)  # the last piece; -1 for bytes
        best[0] = 0
        for i in range(width):
            alive = np.arange(int(np.searchsorted(-sizes, -i, "left")))  # longest first: those longer than i
            node = np.zeros(len(alive), np.int64)
            for j in range(i + 1, width + 1):
                key = node << 21 | codes[alive, j - 1]
                at = np.minimum(np.searchsorted(edges, key), len(edges) - 1)
                hit = edges[at] == key
                if j == i + 1:
                    # A character that is no piece is written in bytes.
                    own = np.where(hit, score[leads[at]], NEVER)
                    bare = alive[own == NEVER]
                    total = best[i, bare] + raw[bare, i]
                    better = total > best[j, bare]
                    best[j, bare[better]], back[j, bare[better]], last[j, bare[better]] = total[better], i, -1
                alive, node = alive[hit], leads[at[hit]]
                inside = sizes[alive] > j
                value = score[node]
                total = best[i, alive] + value
                better = (value > NEVER) & (total > best[j, alive])
                who = alive[better]
                best[j, who], back[j, who], last[j, who] = total[better], i, piece[node[better]]
                alive, node = alive[inside], node[inside]
                if not len(alive):
                    break
        # All words are traced back together, a piece a step; the last piece comes first.
        row, stop, steps = np.arange(len(texts)), sizes, []
        while len(row):
            steps.append((row, last[stop, row]))
            stop = back[stop, row]
            row, stop = row[stop > 0], stop[stop > 0]
        ends = np.cumsum(np.bincount(np.concatenate([r for r, _ in steps]), minlength=len(texts)))
        flat = np.empty(int(ends[-1]), np.int32)
        for k, (row, ids) in enumerate(steps):
            flat[ends[row] - 1 - k] = ids
        packed, stops = flat.tobytes(), (4 * ends).tolist()
        out = {w: packed[a:b] for w, a, b in zip(texts, [0, *stops[:-1]], stops, strict=True)}
        for row in np.unique(np.concatenate([r[ids < 0] for r, ids in steps])).tolist():
            # Words with characters in bytes: as many ids as bytes.
            out[texts[row]] = self._with_bytes(texts[row], back[:, row].tolist(), last[:, row].tolist())
        return out

    def _with_bytes(self, word: str, starts: list[int], ends: list[int]) -> bytes:
        """The packed ids of a word by its best cut: where each last piece starts, and which it is; -1 for bytes."""
        ids, stop = [], len(word)
        while stop:
            start = starts[stop]
            if ends[stop] >= 0:
                ids.append(ends[stop])
            else:
                ids.extend(self.bytes[b] for b in reversed(word[start:stop].encode()))
            stop = start
        return array("i", ids[::-1]).tobytes()

    def score(self, ids) -> int:
        return int(self.scores[np.array(ids, np.int64)].sum())

    def matrix(self, text: str, size: int) -> np.ndarray:
        """Best sums of a chunk of ``size`` characters, from entering at j to leaving at size + k.

        ``text`` goes on after the chunk as far as a piece can reach.
        """
        states = self.longest
        out = np.full((states, states), NEVER, np.int64)
        cuts = [c for c in cut_positions(text) if states <= c <= size - 1]
        if not cuts:
            for j in range(min(states, size)):
                best, _ = self.forward(text, j, size)
                for k in range(min(states, len(text) - size + 1)):
                    out[j, k] = best[size + k]
        else:
            # All paths pass through the first and the last cut: only the ends depend on the states.
            first, last = cuts[0], cuts[-1]
            head = np.array([self.forward(text[:first], j)[0][first] for j in range(states)])
            middle = self.score(self.encode(text[first:last]))
            best, _ = self.forward(text[last:], 0, size - last)
            tail = np.full(states, NEVER, np.int64)
            reach = min(states, len(text) - size + 1)
            tail[:reach] = best[size - last : size - last + reach]
            possible = (head[:, None] > NEVER) & (tail[None, :] > NEVER)
            out = np.where(possible, head[:, None] + middle + tail[None, :], NEVER)
        for j in range(size, states):
            out[j, j - size] = 0  # entered beyond a short chunk's end: it only passes on
        return out

    def between(self, text: str, size: int, enter: int, leave: int) -> list[int]:
        """The ids of a chunk's part of the best path."""
        if enter >= size:
            return []
        cuts = [c for c in cut_positions(text) if enter < c < size]
        if not cuts:
            _, back = self.forward(text, enter, size)
            return self.trace(back, enter, size + leave)
        first, last = cuts[0], cuts[-1]
        _, back = self.forward(text[:first], enter)
        out = self.trace(back, enter, first) + self.encode(text[first:last])
        _, back = self.forward(text[last:], 0, size - last)
        return out + self.trace(back, 0, size - last + leave)

    def decode(self, ids) -> str:
        text = self.text
        return b"".join([text[i] for i in ids]).decode()


def cut_positions(text: str) -> list[int]:
    """Where a word starts: at a space that follows another character. No piece lies across."""
    out, at = [], text.find(SPACE, 1)
    while at >= 0:
        if text[at - 1] != SPACE:
            out.append(at)
        at = text.find(SPACE, at + 1)
    return out


def words(text: str) -> list[str]:
    """The text cut at all cut positions."""
    if SPACE * 2 in text:
        cuts = [0, *cut_positions(text), len(text)]
        return [text[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    parts = text.split(SPACE)
    return ([parts[0]] if parts[0] else []) + [SPACE + p for p in parts[1:]]


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The max-plus product."""
    return np.maximum((a[:, :, None] + b[None, :, :]).max(axis=1), NEVER)


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def scan(matrices: list[np.ndarray]) -> list[tuple[int, int]]:
    """The state in which each chunk is entered and left on the best path through all of them.

    Products over ever longer runs of chunks (one more doubling each round) give every prefix's best sums.
    """
    n, states = len(matrices), len(matrices[0])
    ahead = list(matrices)
    width = 1
    while width < n:
        ahead = [ahead[i] if i < width else product(ahead[i - width], ahead[i]) for i in range(n)]
        width *= 2
    before = [np.where(np.arange(states) == 0, 0, NEVER), *[m[0] for m in ahead[:-1]]]
    out, leave = [], 0
    for i in range(n - 1, -1, -1):
        enter = int((before[i] + matrices[i][:, leave]).argmax())
        out.append((enter, leave))
        leave = enter
    return out[::-1]


def _chunk_task(path: str, size: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reach = vocabulary(path).longest
        for batch in batches:
            for k in range(len(batch)):
                doc_id, sha, text = (batch.column(c)[k].as_py() for c in ("doc_id", "sha", "text"))
                starts = list(range(0, len(text), size))
                for first in range(0, len(starts), _SLICE_CHUNKS):
                    some = starts[first : first + _SLICE_CHUNKS]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([doc_id] * len(some), pa.int64()), pa.array([sha] * len(some)), pa.array([a // size for a in some], pa.int64()),
                            pa.array([min(size, len(text) - a) for a in some], pa.int64()), pa.array([text[a : a + size + reach] for a in some]),
                        ],
                        names=["doc_id", "sha", "n", "size", "text"],
                    )

    return task


def _slices(batch: pa.RecordBatch, column: str, chars: int = _SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose strings, or lists, in the column hold about so many entries; one longer row is a run of its own."""
    sizes = pc.binary_length(batch.column(column)) if pa.types.is_string(batch.column(column).type) else pc.list_value_length(batch.column(column))
    ends = np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(batch):
        stop = int(np.searchsorted(ends, (ends[start - 1] if start else 0) + chars, "right"))
        stop = max(stop, start + 1)
        yield batch.slice(start, stop - start)
        start = stop


def _matrix_task(path: str):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            for start in range(0, len(batch), _SLICE_CHUNKS):
                part = batch.slice(start, _SLICE_CHUNKS)
                made = [v.matrix(t, n).tobytes() for t, n in zip(part.column("text").to_pylist(), part.column("size").to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in ("doc_id", "sha", "n")], pa.array(made, pa.binary())], names=["doc_id", "sha", "n", "matrix"])

    return task


def _packed(found: list[bytes], mask: pa.Array | None = None) -> pa.ListArray:
    """Lists of ids from packed int32."""
    ends = np.cumsum([0, *[len(x) // 4 for x in found]])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(found), np.int32)), mask=mask)


def _scan_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(len(batch)):
            chunks = batch.column("chunks")[i].as_py()
            matrices = [np.frombuffer(c["matrix"], np.int64) for c in chunks]
            side = int(len(matrices[0]) ** 0.5)
            states = scan([m.reshape(side, side) for m in matrices])
            rows = [batch.column(c).slice(i, 1).take(pa.array([0] * len(chunks))) for c in ("doc_id", "sha")]
            numbers = [[c["n"] for c in chunks], [a for a, _ in states], [b for _, b in states]]
            yield pa.RecordBatch.from_arrays([*rows, *[pa.array(x, pa.int64()) for x in numbers]], names=["doc_id", "sha", "n", "enter", "leave"])


def _trace_task(path: str):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            for start in range(0, len(batch), _SLICE_CHUNKS):
                part = batch.slice(start, _SLICE_CHUNKS)
                each = zip(*(part.column(c).to_pylist() for c in ("text", "size", "enter", "leave")), strict=True)
                ids = _packed([array("i", v.between(*x)).tobytes() for x in each])
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in ("doc_id", "sha", "n")], ids], names=["doc_id", "sha", "n", "ids"])

    return task


def _encode_task(path: str):
    """Texts of one chunk."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            for part in _slices(batch, "text"):
                found = v.encode_all([t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), _packed(found, part.column("text").is_null())], names=["doc_id", "ids"])

    return task


def encode(documents: DataFrame, model: str = MODEL, chunk: int = CHUNK) -> DataFrame:
    """``(doc_id, ids)``: the piece ids of every row of ``documents (doc_id, text)``.

    The sum of scores does not depend on ``chunk``; which of equally good cuts is taken can. A null text has null ids, an empty one none. Rows equal in id and
    text get equal ids, each its own row. Further columns are ignored.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    giant = F.coalesce(F.length("text") > chunk, F.lit(False))
    short = rows.where(~giant).mapInArrow(_encode_task(model), "doc_id long, ids array<int>")
    name = ["doc_id", "sha"]
    giants = rows.where(giant).withColumn("sha", F.sha2(F.col("text").cast("binary"), 256))
    chunks = giants.mapInArrow(_chunk_task(model, chunk), "doc_id long, sha string, n long, size long, text string")
    chunks = settled(chunks.dropDuplicates([*name, "n"]), "chunks")
    matrices = chunks.mapInArrow(_matrix_task(model), "doc_id long, sha string, n long, matrix binary")
    per_text = matrices.groupBy(*name).agg(F.sort_array(F.collect_list(F.struct("n", "matrix"))).alias("chunks"))
    states = per_text.mapInArrow(_scan_task, "doc_id long, sha string, n long, enter long, leave long")

    def same(a: str, b: str, *more: str) -> Column:
        return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & F.expr(" and ".join(f"{a}.{c} = {b}.{c}" for c in ("sha", *more)))

    met = chunks.alias("c").join(states.alias("s"), same("c", "s", "n")).select("c.*", "s.enter", "s.leave")
    traced = met.mapInArrow(_trace_task(model), "doc_id long, sha string, n long, ids array<int>")
    whole = traced.groupBy(*name).agg(F.flatten(F.sort_array(F.collect_list(F.struct("n", "ids")))["ids"]).alias("ids"))
    long = giants.select(*name).alias("g").join(whole.alias("w"), same("g", "w")).select("g.doc_id", "w.ids")
    return short.unionByName(long)


def _decode_task(path: str):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            for part in _slices(batch, "ids"):
                ids = part.column("ids")
                texts = [v.decode(x.values.to_numpy().tolist()) if x.is_valid else None for x in ids]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    return task


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """``(doc_id, ids, text)`` for every row of ``encoded (doc_id, ids)``; null ids give a null text."""
    return encoded.select("doc_id", "ids").mapInArrow(_decode_task(model), "doc_id long, ids array<int>, text string")


def digests(decoded: DataFrame) -> DataFrame:
    """``(doc_id, n_pieces, ids_sha256, n_chars, text_sha256)`` of decoded rows; a null text has nulls."""
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_pieces"), F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
    )
