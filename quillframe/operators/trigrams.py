"""Trigram models in one shuffle: runs dealt by their middle word, which has all that its probabilities need in one place."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .language_model import BEGIN, NONE

CHUNK = 1 << 20  # runs that are sorted at once; their different words, under 2 ** 21, are packed three to a key
SHARE = 2_000_000  # runs of one task
_BLOB = "slot int, kind int, size long, a binary, b binary, c binary, n binary, ids binary"
_MODEL = "order int, w1 string, w2 string, w3 string, log_prob double, backoff double"


def _packed(x: np.ndarray, sorted_: bool = False) -> bytes:
    """Whole numbers below 2 ** 32 by planes of their bytes, which compress."""
    if sorted_:
        x = np.diff(x, prepend=0)
    planes = np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes, size: int, sorted_: bool = False) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 4 * size, "zstd", asbytes=True), np.uint8).reshape(4, size)
    x = np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)
    return np.cumsum(x) if sorted_ else x


class _Plan:
    """The words by number (from 1), their counts, and which slots a word in the middle is dealt to; more than one if it is very common."""

    def __init__(self, words: pa.Array, counts: np.ndarray):
        self.words, self.n = words, np.concatenate([[0], counts, [0]]).astype(np.int64)
        self.none, self.every = len(words) + 1, len(words) + 2  # an unknown word; any word before a common one
        self.slots = int(max(1, -(-counts.sum() // SHARE)))
        self.spread = np.minimum(self.slots, np.maximum(1, -(-self.n * self.slots // max(1, int(counts.sum())))))

    def slot(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (b * 2654435761 % 4294967291 + a * 40503 % 65521 % self.spread[b]) % self.slots

    def numbers(self, tokens: pa.Array) -> np.ndarray:
        return pc.fill_null(pc.index_in(tokens, value_set=self.words), len(self.words)).to_numpy(zero_copy_only=False).astype(np.int64) + 1

    def word(self, x: np.ndarray) -> pa.Array:
        return self.words.take(pa.array(x - 1))


def _blobs(plan: _Plan, kind: int, a, b, c, n, ids: list[bytes] | None = None) -> Iterator[pa.RecordBatch]:
    """A record per slot of runs sorted by middle word."""
    slot = plan.slot(a, b) if kind != 1 else a
    order = np.argsort(slot, kind="stable")
    ends = np.searchsorted(slot[order], np.arange(plan.slots + 1))
    rows = []
    for k in np.flatnonzero(np.diff(ends)):
        at = order[ends[k]:ends[k + 1]]
        named = None
        if ids is not None:
            own, local = np.unique(n[at], return_inverse=True)
            named, count = pa.compress(b"\n".join(ids[i] for i in own), "zstd", asbytes=True), local
            named = sum(len(ids[i]) + 1 for i in own).to_bytes(8, "little") + named
        else:
            count = n[at]
        first = np.full(len(at), plan.every) if kind == 1 else a[at]
        rows.append((int(k), kind, len(at), _packed(first), _packed(b[at], True), _packed(c[at]), _packed(count), named))
    if rows:
        kinds = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 5]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], [x.split()[0] for x in _BLOB.split(", ")])


def _counted(key: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """First places of equal sorted keys, and their counts."""
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return at, np.diff(np.append(at, len(key))) if n is None else np.add.reduceat(n, at) if len(at) else n


def _deal(batches, shared) -> Iterator[pa.RecordBatch]:
    """Runs of three of marked texts, with 0 beyond both ends, counted by the million."""
    plan = shared.value
    held, size = [], 0

    def out():
        flat = np.concatenate([*held, [0]])
        for k in range(1, len(flat) - 1, CHUNK // 2):
            b = flat[k:min(k + CHUNK // 2, len(flat) - 1)]
            a, c = flat[k - 1:k - 1 + len(b)], flat[k + 1:k + 1 + len(b)]
            a, b, c = a[b > 0], b[b > 0], c[b > 0]
            if not len(b):
                continue
            own, local = np.unique(np.concatenate([a, b, c]), return_inverse=True)
            a, b, c = local.reshape(3, -1)
            key = np.sort(b << 42 | a << 21 | c)
            at, n = _counted(key)
            key, low = key[at], (1 << 21) - 1
            a, b, c = own[key >> 21 & low], own[key >> 42], own[key & low]
            yield from _blobs(plan, 0, a, b, c, n)
            hot = plan.spread[b] > 1
            if hot.any():  # all slots of a common word learn what follows it
                b, c, n = b[hot], c[hot], n[hot]
                order = np.lexsort((c, b))
                at, n = _counted(b[order] * (plan.every + 1) + c[order], n[order])
                b, c = b[order][at], c[order][at]
                copies = plan.spread[b]
                which = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
                b, c, n = (np.repeat(x, copies) for x in (b, c, n))
                yield from _blobs(plan, 1, (b * 2654435761 % 4294967291 + which) % plan.slots, b, c, n)

    for batch in batches:
        tokens = batch.column(0)
        ids, ends = plan.numbers(tokens.flatten()), np.cumsum(pc.list_value_length(tokens).to_numpy(zero_copy_only=False))
        held.append(np.insert(ids, np.concatenate([[0], ends[:-1]]), 0))
        size += len(ids)
        if size >= 2 * CHUNK:
            yield from out()
            held, size = [], 0
    if held:
        yield from out()


def _ask(batches, shared) -> Iterator[pa.RecordBatch]:
    """Runs of three of the texts to be scored, which begin with two marks, with their ids."""
    plan = shared.value
    for batch in batches:
        tokens, ids = batch.column(1), [x.encode() for x in batch.column(0).to_pylist()]
        lengths = pc.list_value_length(tokens).to_numpy(zero_copy_only=False)
        x = plan.numbers(tokens.flatten())
        owner = np.repeat(np.arange(len(lengths)), lengths)
        inner = np.flatnonzero((owner[2:] == owner[:-2])) + 1
        order = inner[np.argsort(x[inner], kind="stable")]
        yield from _blobs(plan, 2, x[order - 1], x[order], x[order + 1], owner[order], ids)


def _log(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, np.log10(np.where(x > 0, x, 1)), NONE)


def _left(left: np.ndarray, free: np.ndarray) -> np.ndarray:
    return _log(np.where(free > 1e-9, left / np.where(free > 1e-9, free, 1), 0))


def _sum_by(group: np.ndarray, x: np.ndarray, count: int) -> np.ndarray:
    return np.bincount(group, x, count)


def _estimated(batches, shared, discount: float, unknown: float | None) -> Iterator[pa.RecordBatch]:
    """One slot: its rows of the model, or with ``unknown`` its part of what texts score."""
    plan, parts, asked, slot = shared.value, [], [], -1
    for batch in batches:
        for r in batch.to_pylist():
            slot = r["slot"]
            a, b, c, n = (_unpacked(r[k], r["size"], k == "b") for k in "abcn")
            if r["kind"] == 2:
                asked.append((a, b, c, n, pa.decompress(r["ids"][8:], int.from_bytes(r["ids"][:8], "little") - 1, "zstd", asbytes=True).decode().split("\n")))
            else:
                parts.append((a, b, c, n))
    if not parts and not asked:
        return
    empty = np.zeros(0, np.int64)
    a, b, c, n = (np.concatenate(x) for x in zip(*parts)) if parts else (empty,) * 4
    order = np.lexsort((c, a, b))
    a, b, c, n = (x[order] for x in (a, b, c, n))
    at = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1])])) if len(a) else empty
    a, b, c, n = a[at], b[at], c[at], np.add.reduceat(n, at) if len(at) else n
    wide, total = plan.every + 1, plan.n[1:-1].sum() - plan.n[plan.numbers(pa.array([BEGIN], pa.string()))[0]]
    one = plan.n / max(1, total)
    one[plan.numbers(pa.array([BEGIN], pa.string()))[0]] = 0
    # Pairs (b, c), from all that are before b.
    use = np.where(plan.spread[b] > 1, a == plan.every, a != plan.every)
    middles = np.unique(b[use])
    use &= c > 0
    key2 = b[use] * wide + c[use]
    order = np.argsort(key2, kind="stable")
    at, n2 = _counted(key2[order], n[use][order])
    key2 = key2[order][at]
    p2 = (n2 - discount) / plan.n[key2 // wide]
    own = np.searchsorted(middles, key2 // wide)
    kinds, follow = _sum_by(own, np.ones(len(own)), len(middles)), _sum_by(own, one[key2 % wide], len(middles))
    back1 = np.where(kinds > 0, _left(discount * kinds / plan.n[middles], 1 - follow), np.nan)
    # Contexts (a, b), and what follows them.
    real = (a != plan.every) & (a > 0)
    a, b, c, n = (x[real] for x in (a, b, c, n))
    start, nab = _counted(b * wide + a, n)
    group = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(a))))
    ca, cb = a[start], b[start]
    pab = (nab - discount) / plan.n[ca]
    seen = c > 0
    group, c3, n3 = group[seen], c[seen], n[seen]
    all3, kinds3 = _sum_by(group, n3, len(start)), _sum_by(group, np.ones(len(group)), len(start))
    q = p2[np.searchsorted(key2, cb[group] * wide + c3)] if len(group) else np.zeros(0)
    back2 = np.where(kinds3 > 0, _left(discount * kinds3 / np.maximum(all3, 1), 1 - _sum_by(group, q, len(start))), np.nan)
    p3 = (n3 - discount) / all3[group]

    if unknown is None:
        mine = middles[middles * 2654435761 % 4294967291 % plan.slots == slot]
        none = lambda k: pa.nulls(k, pa.string())
        tables = [
            (1, plan.word(mine), none(len(mine)), none(len(mine)), _log(one[mine]), back1[np.searchsorted(middles, mine)]),
            (2, plan.word(ca), plan.word(cb), none(len(ca)), _log(pab), back2),
            (3, plan.word(ca[group]), plan.word(cb[group]), plan.word(c3), _log(p3), np.full(len(group), np.nan)),
        ]
        for k, *words, p, back in tables:
            columns = [pa.array(np.full(len(p), k, np.int32)), *[pa.array(w) if not isinstance(w, pa.Array) else w for w in words], pa.array(p), pa.array(back, mask=np.isnan(back))]
            yield from pa.table(columns, names=["order", "w1", "w2", "w3", "log_prob", "backoff"]).to_batches(max_chunksize=1 << 16)
        return

    def find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Values of sorted keys; nan for those not there."""
        if not len(keys):
            return np.full(len(wanted), np.nan)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, values[at], np.nan)

    contexts = cb * wide + ca
    for a, b, c, who, ids in asked:
        place = np.minimum(np.searchsorted(contexts, b * wide + a), max(0, len(contexts) - 1))
        known = contexts[place] == b * wide + a if len(contexts) else np.zeros(len(a), bool)
        three = np.where(known, find(group * wide + c3, _log(p3), place * wide + c), np.nan)
        k2, k1 = np.nan_to_num(find(contexts, back2, b * wide + a)), np.nan_to_num(find(middles, back1, b))
        lone = np.where(c == plan.none, unknown, _log(one[np.minimum(c, plan.none)]))
        two = find(key2, _log(p2), b * wide + c)
        p = np.where(np.isnan(three), k2 + np.where(np.isnan(two), k1 + lone, two), three)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(np.bincount(who, minlength=len(ids))), pa.array(_sum_by(who, p, len(ids)))], ["id", "n", "log_prob"])


def _plan(df: DataFrame, tokens: str):
    """The words and their counts pass the driver: some tenths of a GB for a corpus of 30 GB."""
    words = df.select(F.explode(tokens).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")).toArrow()
    kept = words.column("w").combine_chunks()
    plan = _Plan(kept if isinstance(kept, pa.Array) else pa.concat_arrays(kept.chunks), words.column("n").to_numpy())
    return plan, df.sparkSession.sparkContext.broadcast(plan)


def backoff_model(df: DataFrame, tokens: str, discount: float = 0.5) -> DataFrame:
    """``language_model.backoff_model``: the same rows, by one shuffle of packed runs."""
    plan, shared = _plan(df, tokens)
    dealt = df.select(tokens).mapInArrow(lambda x: _deal(x, shared), _BLOB).repartitionById(plan.slots, F.col("slot"))
    return dealt.mapInArrow(lambda x: _estimated(x, shared, discount, None), _MODEL)


def backoff_scores(texts: DataFrame, tokens: str, df: DataFrame, id_col: str, asked: str, unknown: float = -7.0, discount: float = 0.5) -> DataFrame:
    """``language_model.backoff_scores`` of ``df`` by the model of ``texts``: runs to be scored are dealt like those that the model is made of. Ids are strings without line breaks."""
    plan, shared = _plan(texts, tokens)
    dealt = texts.select(tokens).mapInArrow(lambda x: _deal(x, shared), _BLOB)
    twice = F.concat(F.array(F.lit(BEGIN)), F.col(asked))
    dealt = dealt.unionByName(df.select(F.col(id_col), twice.alias("s")).mapInArrow(lambda x: _ask(x, shared), _BLOB))
    scored = dealt.repartitionById(plan.slots, F.col("slot")).mapInArrow(lambda x: _estimated(x, shared, discount, unknown), "id string, n long, log_prob double")
    return scored.groupBy(F.col("id").alias(id_col)).agg(F.sum("n").alias("n"), F.sum("log_prob").alias("log_prob"))
