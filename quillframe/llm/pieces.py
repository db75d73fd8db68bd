"""SentencePiece encoding and decoding by a parallel max-plus scan.

A segmentation is a best path through the lattice of pieces. In a unigram model
a piece weighs its score. A BPE model's encoding is the one path on which every
two neighbouring pieces would also be encoded as just these two when alone; a
pair weighs nothing if so and minus infinity if not. In both, all that the text
before a cut tells about the text behind it is the piece that reaches or
crosses the cut. A chunk of a giant document therefore yields a matrix from the
states at its left edge to those at its right one; matrices combine
associatively under max and plus; and once the state at each cut is known every
chunk traces its own pieces back.

Chunks have a fixed number of characters and are cut wherever that ends, within
words too. Matrices are combined in groups of bounded size, groups of groups
and so on up to whole documents, and the states handed down the same way. Short
documents are one chunk. Inside a chunk, stretches that no piece enters or
leaves are looked up, as their encoding is the same everywhere; a chunk's
matrix is then a column up to the first such place times a row from the last.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import extended, forgotten, small_batches, task_id, written

CHUNK = 1 << 15
GIANT = 2 * CHUNK
FAN = 64
_SPACE = "▁"
_MEMO, _MEMO_WORD = 200_000, 48  # strings in the memo, some 220 bytes each with their ids, and characters of one
_PAIRS = 250_000  # some 100 bytes each
_DEAD = float("-inf")

#: A state at a cut: how many characters the last piece reaches beyond it, and that piece's id where the model asks for it.
State = tuple[int, int]


@dataclass
class Model:
    """A SentencePiece model: its pieces, and which of the two path weights it has."""

    ids: dict[str, int]
    scores: list[float]
    texts: list[str | None]
    bytes_: list[int]
    unknown: int
    bpe: bool
    prefix: bool
    longest: int
    words: dict[str, bytes] = field(default_factory=dict, repr=False)
    pairs: dict[int, bool] = field(default_factory=dict, repr=False)
    cut: re.Pattern | None = None
    sizes: list[int] = field(default_factory=list, repr=False)
    plain: pa.BinaryArray | None = field(default=None, repr=False)

    def __post_init__(self) -> None:
        # Lengths of pieces, in the order in which they are tried: two and three first, as most are that long.
        self.sizes = sorted(set(map(len, self.ids)) | {1}, key=lambda n: (n not in (2, 3), n))

    def __getstate__(self) -> dict:
        return self.__dict__ | {"words": {}, "pairs": {}, "plain": None}

    def forget(self) -> None:
        """Drop what was looked up."""
        self.words, self.pairs, self.plain = {}, {}, None

    @classmethod
    def load(cls, path: str) -> Model:
        """The model of a file; ValueError for one that normalises otherwise than by escaping spaces."""
        from sentencepiece import sentencepiece_model_pb2 as proto

        m = proto.ModelProto()
        with open(path, "rb") as f:
            m.ParseFromString(f.read())
        n = m.normalizer_spec
        if n.precompiled_charsmap or n.remove_extra_whitespaces or not n.escape_whitespaces or m.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("this model changes texts before it encodes them")
        kind = {1: False, 2: True}.get(m.trainer_spec.model_type)
        if kind is None:
            raise ValueError("neither a unigram nor a BPE model")
        ids = {p.piece: i for i, p in enumerate(m.pieces) if p.type in (1, 4)}
        by_byte = {p.piece: i for i, p in enumerate(m.pieces) if p.type == 6}
        texts = [p.piece if p.type in (1, 4) else None for p in m.pieces]
        inner = any(_SPACE in p.lstrip(_SPACE) for p in ids)
        return cls(
            ids, [p.score for p in m.pieces], texts,
            [by_byte[f"<0x{b:02X}>"] for b in range(256)] if len(by_byte) == 256 else [],
            next(i for i, p in enumerate(m.pieces) if p.type == 2), kind, n.add_dummy_prefix, max(map(len, ids), default=1),
            cut=None if inner else re.compile(f"{_SPACE}*[^{_SPACE}]+|{_SPACE}+"),
        )

    # Lattice. An unknown character is a piece of its own, with an id below zero that no pair forbids.

    def known(self, piece: str) -> int | None:
        found = self.ids.get(piece)
        return -1 - ord(piece) if found is None and len(piece) == 1 else found

    def text(self, piece: int) -> str:
        return chr(-1 - piece) if piece < 0 else self.texts[piece]

    def weight(self, piece: int) -> float:
        if self.bpe:
            return 0.0
        return self.scores[piece] if piece >= 0 else min(self.scores) - 10.0

    def fits(self, left: int, right: int) -> bool:
        """Whether two pieces are each other's neighbours when encoded alone. Always so without BPE, or beside an unknown character."""
        if not self.bpe or left < 0 or right < 0:
            return True
        both = left * len(self.texts) + right
        found = self.pairs.get(both)
        if found is None:
            if len(self.pairs) >= _PAIRS:
                self.pairs.clear()
            a, b = self.texts[left], self.texts[right]
            found = self.pairs[both] = self.merged(a + b) == [a, b]
        return found

    def merged(self, text: str) -> list[str]:
        """A short string's pieces by merging, again and again, the two neighbours whose joint piece scores best, leftmost first."""
        parts = list(text)
        while True:
            best, at = _DEAD, -1
            for i in range(len(parts) - 1):
                joint = self.ids.get(parts[i] + parts[i + 1])
                if joint is not None and self.scores[joint] > best:
                    best, at = self.scores[joint], i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    # Scan.

    def forward(self, text: str, size: int, start: State, like: list | None = None) -> list[dict[int, tuple[float, int, int]]]:
        """Best paths from ``start`` through the first ``size`` characters of ``text``; the rest is what pieces may reach into.

        For each end of a piece: by its id (0 in a unigram model) the weight,
        the piece's beginning, and the entry it follows. ``like`` is the result
        from another start: where the ways left are the same but for a constant
        weight, they stay so and the rest is taken from it.
        """
        ends: list[dict] = [{} for _ in range(size + self.longest + 1)]
        reach, last = start
        if reach <= size + self.longest:
            ends[reach][last] = (0.0, -1, 0)
        for i in range(reach, size):
            if like and i % self.longest == 0 and (gap := _same(ends[i:i + self.longest], like[i:i + self.longest])) is not None:
                for j in range(i, len(ends)):
                    ends[j] = {k: (w + gap, b, link) for k, (w, b, link) in like[j].items()}
                return ends
            if not (before := ends[i]):
                continue
            for n in range(1, min(self.longest, len(text) - i) + 1):
                piece = self.known(text[i:i + n])
                if piece is None:
                    continue
                weight = self.weight(piece)
                key = piece if self.bpe else 0
                for last, (total, _, _) in before.items():
                    if total + weight > ends[i + n].get(key, (_DEAD,))[0] and (last == _START or self.fits(last, piece)):
                        ends[i + n][key] = (total + weight, i, last) if self.bpe else (total + weight, i, piece)
        return ends

    def entries(self, text: str, at: int) -> list[State]:
        """The states possible at a cut: pieces that end at or cross ``text[at]``, by the text around it."""
        found = {}
        for i in range(max(0, at - self.longest), at):
            for j in range(max(i + 1, at), min(len(text), i + self.longest) + 1):
                piece = self.known(text[i:j])
                if piece is not None:
                    found[(j - at, piece if self.bpe else 0)] = None
        return list(found)

    def hard(self, body: str) -> tuple[int, int] | None:
        """The first and the last place in a chunk that no piece crosses, or None."""
        if self.cut is None:
            return None
        first = next((m.start() + 1 for m in _EDGE.finditer(body)), None)
        if first is None:
            return None
        last = body.rfind(_SPACE)
        while body[last - 1] == _SPACE:
            last -= 1
        return first, last

    def ways(self, text: str, size: int, starts: Iterable[State]) -> dict[State, dict[State, float]]:
        """Best weights from states at the beginning of ``text[:size]`` to those at its end, where there is a way, piece by piece."""
        out, first = {}, None
        for start in starts:
            if start[0] >= size:
                out[start] = {(start[0] - size, start[1]): 0.0}
                continue
            ends = self.forward(text, size, start, first)
            out[start] = {(e - size, k): v[0] for e in range(size, len(ends)) for k, v in ends[e].items()}
            first = first or ends
        return out

    def matrix(self, text: str, size: int, starts: Iterable[State]) -> dict[State, dict[State, float]]:
        """Best weights from the states at a chunk's left edge to those at its right edge, where there is a way.

        At a place that no piece crosses all ways meet, and what follows does
        not depend on what came before.
        """
        cuts = self.hard(text[:size])
        if cuts is None:
            return self.ways(text, size, starts)
        first, last = cuts
        column = {s: max(row.values()) for s, row in self.ways(text[:first], first, starts).items() if row}
        middle = 0.0 if self.bpe or first == last else max(self.ways(text[first:last], last - first, [(0, _START)])[0, _START].values())
        row = self.ways(text[last:], size - last, [(0, _START)])[0, _START]
        return {s: {end: x + middle + y for end, y in row.items()} for s, x in column.items()}

    def trace(self, stretches: Iterable[tuple[str, int, State, State]]) -> list[list[int]]:
        """For chunks (text, size, start, end), each by itself, the ids of the pieces that begin in it, on the best way from one edge state to the other."""
        out, middles = [], []
        for text, size, start, end in stretches:
            cuts = self.hard(text[:size])
            if cuts is None:
                out.append((list(self.ids_of(self.back(text, size, start, end))), []))
                middles.append([])
                continue
            first, last = cuts
            out.append((
                list(self.ids_of(self.back(text[:first], first, start, None))), list(self.ids_of(self.back(text[last:], size - last, (0, _START), end))),
            ))
            middles.append(self.parts(text[first:last]))
        return [left + middle.tolist() + right for (left, right), middle in zip(out, self.encode_parts(middles))]

    def back(self, text: str, size: int, start: State, end: State | None) -> list[int]:
        """The pieces on the best way from one state to the other; no ``end`` is the best one at ``size`` exactly."""
        if start[0] >= size:
            return []
        ends = self.forward(text, size, start)
        if end is None:
            end = (0, max(ends[size], key=lambda k: ends[size][k][0]))
        at, key, out = size + end[0], end[1], []
        while True:
            total, begin, link = ends[at][key]
            if begin < 0:
                return out[::-1]
            out.append(key if self.bpe else link)
            at, key = begin, link if self.bpe else next(iter(ends[begin]))

    def learn(self, words: Iterable[str]) -> dict[str, bytes]:
        """The packed ids of strings that share no piece with their neighbours: the lattice of one chunk each.

        Of a BPE lattice from a fixed beginning every position keeps one way at
        most, the encoding of the string up to there. In sorted order a string
        takes over what it shares with the one before.
        """
        ids, fits, pairs, many, sizes = self.ids.get, self.fits, self.pairs.get, len(self.texts), self.sizes
        found: dict[str, bytes] = {}
        before, last, begin = "", [_START], [-1]
        for text in sorted(words):
            n = len(text)
            if n > CHUNK or not self.bpe:
                found[text] = array("i", self.scan(text)).tobytes()
                continue
            same, most = 0, min(n, len(before))
            while same < most and before[same] == text[same]:
                same += 1
            del last[same + 1:], begin[same + 1:]
            for j in range(same + 1, n + 1):
                for size in sizes:
                    i = j - size
                    if i < 0:
                        continue
                    piece = ids(text[i:j])
                    if piece is None:
                        if size > 1:
                            continue
                        piece = -1 - ord(text[i])
                    if i:
                        left = last[i]
                        if left >= 0 and piece >= 0:
                            fit = pairs(left * many + piece)
                            if not (fits(left, piece) if fit is None else fit):
                                continue
                    last.append(piece)
                    begin.append(i)
                    break
            before, out, at = text, [], n
            while at > 0:
                out.append(last[at])
                at = begin[at]
            out.reverse()
            found[text] = array("i", out if min(out) >= 0 else self.ids_of(out)).tobytes()
        return found

    def scan(self, text: str, size: int = CHUNK) -> list[int]:
        """Ids of a normal text of any length by chunks, here one after the other."""
        parts = list(chunks(self, text, size))
        states = walk([chunk_matrix(self, *part) for part in parts])
        return sum(self.trace((body + after, len(body), a, b) for (_, body, after), a, b in zip(parts, states, states[1:])), [])

    def ids_of(self, pieces: Iterable[int]) -> Iterator[int]:
        """Ids for pieces; an unknown character becomes its bytes where the model has them."""
        for p in pieces:
            if p >= 0:
                yield p
            elif self.bytes_:
                yield from (self.bytes_[b] for b in chr(-1 - p).encode("utf-8", "surrogatepass"))
            else:
                yield self.unknown

    # Texts.

    def normal(self, text: str) -> str:
        text = text.replace(" ", _SPACE)
        return _SPACE + text if self.prefix and text else text

    def parts(self, normal: str) -> list[str]:
        """A normal text cut where no piece can cross."""
        return self.cut.findall(normal) if self.cut else [normal] if normal else []

    def encode_parts(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Ids of texts by their parts. What no earlier text needed is learned at once; the memo keeps no very long part and a bounded number."""
        memo = self.words
        flat = [w for parts in texts for w in parts]
        got = list(map(memo.get, flat))
        if None in got:
            new = self.learn(set(compress(flat, [g is None for g in got])))
            got = [new[w] if g is None else g for w, g in zip(flat, got)]
            if len(memo) + len(new) > _MEMO:
                memo.clear()
            if len(new) <= _MEMO:
                memo.update((w, x) for w, x in new.items() if len(w) <= _MEMO_WORD)
        out, at = [], 0
        for parts in texts:
            out.append(np.frombuffer(b"".join(got[at:at + len(parts)]), np.int32))
            at += len(parts)
        return out

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; none for a null or empty one."""
        return self.encode_parts([self.parts(self.normal(text or ""))])[0].tolist()

    def decode_all(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The texts of lists of ids, which follow each other in ``ids`` and stop at ``ends``.

        Pieces and bytes are joined, spaces restored, the prefix taken off, and
        bytes that are no UTF-8 replaced. An id outside the vocabulary is a ValueError.
        """
        if len(ids) and not 0 <= ids.min() <= ids.max() < len(self.texts):
            raise ValueError("an id is outside the vocabulary")
        if self.plain is None:
            value = {p: bytes([b]) for b, p in enumerate(self.bytes_)}
            self.plain = pa.array([value.get(i, (t or "").replace(_SPACE, " ").encode("utf-8", "surrogatepass")) for i, t in enumerate(self.texts)], pa.large_binary())
        joined = pc.take(self.plain, pa.array(ids, pa.int32()))
        offsets = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset:][: len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
        raw = joined.buffers()[2].to_pybytes() if len(ids) else b""
        cuts = offsets[np.concatenate(([0], ends))].tolist()
        drop = int(self.prefix)
        return [raw[a + drop if raw[a:a + drop] == b" " and a < b else a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:])]

    def decode(self, ids: list[int]) -> str:
        """The text of ids. ``encode`` loses nothing but the escape character itself."""
        return self.decode_all(np.array(ids, np.int32), np.array([len(ids)]))[0]


_EDGE = re.compile(f"[^{_SPACE}](?={_SPACE})")
_START = -(1 << 30)  # no piece: the beginning of a document


def _same(a: list[dict], b: list[dict]) -> float | None:
    """The constant by which the weights of ``a`` exceed those of ``b``; None if there is no such constant."""
    gap = None
    for x, y in zip(a, b):
        if x.keys() != y.keys():
            return None
        for k, v in x.items():
            if gap is None:
                gap = v[0] - y[k][0]
            elif abs(v[0] - y[k][0] - gap) > 1e-9:
                return None
    return gap


def chunk_matrix(model: Model, before: str, body: str, after: str) -> dict[State, dict[State, float]]:
    """A chunk's matrix. ``before`` and ``after`` are the characters around it, as many as the longest piece has; a first chunk has none before."""
    starts = model.entries(before + body + after, len(before)) if before else [(0, _START)]
    return model.matrix(body + after, len(body), starts)


def combine(a: dict[State, dict[State, float]], b: dict[State, dict[State, float]]) -> dict[State, dict[State, float]]:
    """The max-plus product of the matrices of two adjoining stretches; associative."""
    out: dict[State, dict[State, float]] = {}
    for start, row in a.items():
        sums: dict[State, float] = {}
        for middle, x in row.items():
            for end, y in b.get(middle, {}).items():
                if x + y > sums.get(end, _DEAD):
                    sums[end] = x + y
        out[start] = sums
    return out


def walk(tables: list[dict[State, dict[State, float]]], start: State | None = None, end: State | None = None) -> list[State]:
    """The best path's state at every cut of a stretch, both ends included, from its chunks' matrices.

    Without ``start`` the stretch begins its document, without ``end`` it ends
    it. Products up to each cut give the best weights; the way back picks at
    each cut the state from which the one after it is reached with just that.
    """
    start = start or (0, _START)
    totals = [{start: 0.0}]
    for t in tables:
        totals.append(combine({start: totals[-1]}, t)[start])
    if end is None:
        end = max((s for s in totals[-1] if s[0] == 0), key=lambda s: totals[-1][s])
    states = [end]
    for total, table in zip(reversed(totals[:-1]), reversed(tables)):
        states.append(max((s for s in total if states[-1] in table.get(s, {})), key=lambda s: total[s] + table[s][states[-1]]))
    return states[::-1]


# DataFrames.


def chunks(model: Model, text: str, size: int = CHUNK) -> Iterator[tuple[str, str, str]]:
    """(before, body, after) of the chunks of a normal text: ``size`` characters each, with as many around them as the longest piece has."""
    for at in range(0, len(text), size):
        yield text[max(0, at - model.longest):at], text[at:at + size], text[at + size:at + size + model.longest]


def _lists(batch_ids: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in batch_ids]))).astype(np.int32)
    flat = np.concatenate(batch_ids) if batch_ids else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))


_TEXTS = 1 << 20  # characters whose parts are learned at once


def encode(
    df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", giant: int = GIANT, size: int = CHUNK, fan: int = FAN,
    with_text: bool = False,
) -> DataFrame:
    """(id_col, ids array<int>[, text]) for every row of ``df``; no ids for a null or empty text.

    Texts of over ``giant`` characters are cut into chunks of ``size`` whose
    matrices are made in parallel, combined ``fan`` at a time in as many levels
    as the longest document needs, and traced back in parallel. ``with_text``
    adds the text that the ids decode to. Repeated rows each get a row; other
    columns are ignored; an empty table gives an empty one.
    """
    spark = df.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    large = F.coalesce(F.length("t"), F.lit(0)) > giant
    names = ["id", "ids", "text"] if with_text else ["id", "ids"]

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            held, first, size = [], 0, 0
            for i, text in enumerate(batch.column(1)):
                text = text.as_py() or ""
                held.append(model.parts(model.normal(text)))
                size += len(text)
                if size >= _TEXTS or i + 1 == batch.num_rows:
                    columns = [batch.column(0).slice(first, len(held)), _lists(model.encode_parts(held))]
                    if with_text:
                        columns.append(_decoded(model, columns[1]))
                    yield pa.RecordBatch.from_arrays(columns, names=names)
                    held, first, size = [], i + 1, 0

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, (part, _), row = shared.value, task_id(), 0
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                row += 1
                for i, (before, body, after) in enumerate(chunks(model, model.normal(text.as_py()), size)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key.as_py()], batch.column(0).type), pa.array([f"{part}-{row}"]), *map(pa.array, ([i], [before], [body], [after]))],
                        names=["id", "doc", "place", "before", "body", "after"],
                    )

    def matrices(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for frame in frames:
            found = [_packed(chunk_matrix(model, *part)) for part in zip(frame.before, frame.body, frame.after)]
            yield pd.DataFrame({"doc": frame.doc, "place": frame.place, "matrix": found})

    def traced(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for frame in frames:
            for at in range(0, len(frame), 32):
                part = frame.iloc[at:at + 32]
                found = model.trace(
                    (body + after, len(body), tuple(map(int, start)), tuple(map(int, end)))
                    for body, after, start, end in zip(part.body, part.after, part.start, part.end)
                )
                yield pd.DataFrame({"id": part.id, "doc": part.doc, "place": part.place, "ids": pd.Series(found, index=part.index)})

    def forgetting(work):  # noqa: ANN001, ANN202
        return lambda batches: forgotten(work(batches), lambda: shared.value.forget())

    short = texts.where(~large).mapInArrow(forgetting(whole), extended(df, id_col, "ids array<int>" + ", text string" * with_text, "id"))
    parts = written(
        texts.where(large).mapInArrow(split, extended(df, id_col, "doc string, place long, before string, body string, after string", "id")), "chunks"
    )
    if not parts.isEmpty():
        tables = written(parts.select("doc", "place", "before", "body", "after").mapInPandas(forgetting(matrices), "doc string, place long, matrix binary"), "matrices")
        joined = parts.join(_states(tables, fan), ["doc", "place"])
        ids = joined.mapInPandas(forgetting(traced), extended(df, id_col, "doc string, place long, ids array<int>", "id"))
        ids = ids.groupBy("doc", "id").agg(F.array_sort(F.collect_list(F.struct("place", "ids"))).alias("all")).select("id", F.flatten("all.ids").alias("ids"))
        if with_text:
            ids = ids.mapInArrow(_decoder(shared, ["id", "ids", "text"]), extended(df, id_col, "ids array<int>, text string", "id"))
        short = short.unionByName(ids)
    return short.select(F.col("id").alias(id_col), *names[1:])


def _states(tables: DataFrame, fan: int) -> DataFrame:
    """(doc, place, start, end) of every chunk: matrices are combined ``fan`` at a time, level by level, and states handed down."""
    edge = "start array<long>, end array<long>"

    def product(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("place")
        whole = _unpacked(frame.matrix.iat[0])
        for raw in frame.matrix.iloc[1:]:
            whole = combine(whole, _unpacked(raw))
        return pd.DataFrame({"doc": [frame.doc.iat[0]], "place": [int(frame.place.iat[0]) // fan], "matrix": [_packed(whole)]})

    def inner(frame: pd.DataFrame, start: State | None, end: State | None) -> pd.DataFrame:
        frame = frame.sort_values("place")
        found = walk([_unpacked(m) for m in frame.matrix], start, end)
        return pd.DataFrame({"doc": frame.doc, "place": frame.place, "start": [list(s) for s in found[:-1]], "end": [list(s) for s in found[1:]]})

    def below(frame: pd.DataFrame) -> pd.DataFrame:
        return inner(frame, tuple(map(int, frame.start.iat[0])), tuple(map(int, frame.end.iat[0])))

    levels = [tables]
    while levels[-1].agg(F.max("place")).first()[0] >= fan:
        groups = levels[-1].groupBy("doc", F.floor(F.col("place") / fan).alias("group"))
        levels.append(written(groups.applyInPandas(product, "doc string, place long, matrix binary"), "matrices"))
    found = levels.pop().groupBy("doc").applyInPandas(lambda frame: inner(frame, None, None), f"doc string, place long, {edge}")
    while levels:
        up = found.select("doc", F.col("place").alias("group"), "start", "end")
        members = levels.pop().withColumn("group", F.floor(F.col("place") / fan)).join(up, ["doc", "group"])
        found = members.groupBy("doc", "group").applyInPandas(below, f"doc string, place long, {edge}")
    return found


def _packed(table: dict[State, dict[State, float]]) -> bytes:
    rows = [(*s, *e, v) for s, row in table.items() for e, v in row.items()]
    return np.array(rows, np.float64).tobytes()


def _unpacked(raw: bytes) -> dict[State, dict[State, float]]:
    table: dict[State, dict[State, float]] = {}
    for a, b, c, d, v in np.frombuffer(raw, np.float64).reshape(-1, 5).tolist():
        table.setdefault((int(a), int(b)), {})[int(c), int(d)] = v
    return table


def _decoded(model: Model, lists: pa.ListArray) -> pa.Array:
    """Texts of lists of ids; null lists and null ids in them count as none."""
    if lists.null_count or lists.values.null_count:
        lists = pa.array([[i for i in ids.as_py() or () if i is not None] for ids in lists], pa.list_(pa.int32()))
    offsets = lists.offsets.to_numpy()
    flat = lists.values.to_numpy()[offsets[0]:offsets[-1]]
    return pa.array(model.decode_all(flat, offsets[1:] - offsets[0]), pa.string())


def _decoder(shared, names: list[str]):  # noqa: ANN001, ANN202
    """A function of Arrow batches that puts the texts of the last column's ids behind the columns before ``names[-1]``."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays([*part.columns[:len(names) - 1], _decoded(shared.value, part.columns[-1])], names=names)

    return of


def decode(df: DataFrame, model: Model, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id_col, text) for every row of ``df``; an empty text for null or no ids.

    Null ids in a list are passed over, an id outside the vocabulary raises a
    ValueError. Repeated rows each get a row; an empty table gives an empty one.
    """
    small_batches(df.sparkSession)
    of = _decoder(df.sparkSession.sparkContext.broadcast(model), [id_col, "text"])
    return df.select(id_col, ids_col).mapInArrow(of, extended(df, id_col, "text string"))
