"""SentencePiece encoding and decoding by batched numpy Viterbi.

A text becomes units: a space mark with the word behind it, cut at characters
that no piece has (those become byte pieces). Each distinct unit of a batch
is solved once. Units of equal length advance together, one character a step:
substring hashes probe the sorted piece keys, the best of the up to
``max piece length`` ways into a position is taken by vectorised maxima, and
its length is stored as backpointer.

A way adds the piece's score (unigram models). In a BPE model, whose result is
fixed by the order of merges and not by a sum of scores, a way is open only
if the merge order leaves the seam between the two pieces alone, that is if
merging the characters of both gives back those two pieces. For such a model just
one chain of pieces has only untouched seams: the library's own
result. Seams are worked out in batches, once per pair of pieces, and kept. Units in
which no way stays open are merged directly.

Defined cases: null text has null ids and decodes to null; empty text has no
ids and decodes to empty; runs of spaces follow the library; texts that have the
space mark U+2581 itself decode to a space there, as in the library. Whole
texts are encoded; memory follows the batch or the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

MARK = "▁"
_U = np.uint64
_STEP = 0x9E3779B97F4A7C15 | 5
_STEP_INV = pow(_STEP, -1, 1 << 64)
#: Bounds of what a worker keeps between batches, and of a batch.
SEAMS_KEPT = 1 << 21
SEAM_BITS = 21
SEAM_SLOTS = 1 << SEAM_BITS
BATCH_CHARS = 1 << 19


@dataclass
class Pieces:
    """A model's table in arrays; ids are positions."""

    chars: np.ndarray  # ids x longest: code points, 0 behind the end
    size: np.ndarray  # characters of each piece; 0 if it is no ordinary one
    score: np.ndarray
    byte: np.ndarray  # id of the piece of each byte
    raw: list[bytes]  # what each id decodes to
    merges: bool  # BPE model
    unknown: int

    def __post_init__(self) -> None:
        self.longest = self.chars.shape[1]
        own = np.flatnonzero(self.size)
        keys = _prefix_hashes(self.chars)[own, self.size[own]]
        order = np.argsort(keys, kind="stable")
        self.keys, self.key_ids = keys[order], own[order].astype(np.int32)
        # Where the keys with the same top 20 bits begin, and the longest such run.
        tops = (self.keys >> _U(44)).astype(np.int64)
        many = np.bincount(tops, minlength=1 << 20)
        self.near, self.from_top, self.run = many > 0, np.cumsum(many) - many, int(many.max())
        self.keys = np.concatenate((self.keys, np.zeros(self.run, np.uint64)))
        self.key_ids = np.concatenate((self.key_ids, np.full(self.run, -1, np.int32)))
        self.known = np.zeros(0x110000, bool)
        single = own[self.size[own] == 1]
        self.known[self.chars[single, 0]] = True
        self.of_char = np.full(0x110000, -1, np.int32)
        self.of_char[self.chars[single, 0]] = single
        self.mark_id = int(self.of_char[ord(MARK)])
        runs = [i for i in own if set(self.chars[i, : self.size[i]]) == {ord(MARK)}]
        self.run_ids = {int(self.size[i]): int(i) for i in runs}
        self._forget()
        self.raw_size = np.array([len(b) for b in self.raw], np.int64)
        self.raw_start = np.cumsum(self.raw_size) - self.raw_size
        self.raw_bytes = np.frombuffer(b"".join(self.raw), np.uint8)
        if self.merges:
            self._pairs()

    def _pairs(self) -> None:
        """Sorted (left, right) keys of every way to cut a piece in two."""
        n, left, right, whole = len(self.size), [], [], []
        hashes = _prefix_hashes(self.chars)
        for k in range(1, self.longest):
            own = np.flatnonzero(self.size > k)
            a = self.find(hashes[own, k])
            rest = (hashes[own, self.size[own]] - hashes[own, k]) * _powers(_STEP_INV, k + 1)[k]
            b = self.find(rest)
            ok = (a >= 0) & (b >= 0)
            left.append(a[ok]), right.append(b[ok]), whole.append(own[ok])
        keys = np.concatenate(left).astype(np.int64) * n + np.concatenate(right)
        order = np.argsort(keys, kind="stable")
        self.pair_keys, self.pair_ids = keys[order], np.concatenate(whole)[order].astype(np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of the pieces with these hashes, -1 where there is none."""
        out = np.full(hashes.shape, -1, np.int32)
        tops = (hashes >> _U(44)).astype(np.int64)
        may = np.nonzero(self.near[tops])
        h, at, got = hashes[may], self.from_top[tops[may]], np.full(len(may[0]), -1, np.int32)
        for _ in range(self.run):
            np.copyto(got, self.key_ids[at], where=self.keys[at] == h)
            at += 1
        out[may] = got
        return out

    def merged(self, symbols: np.ndarray) -> np.ndarray:
        """Merges rows of piece ids (-1 behind the end), best score first and
        leftmost among equals, until none is left."""
        n = len(self.size)
        symbols, live = symbols.copy(), np.arange(len(symbols))
        columns = np.arange(symbols.shape[1])
        while len(live):
            rows = symbols[live]
            keys = rows[:, :-1].astype(np.int64) * n + rows[:, 1:]
            at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            fits = (self.pair_keys[at] == keys) & (rows[:, 1:] >= 0)
            to = self.pair_ids[at]
            worth = np.where(fits, self.score[to], -np.inf)
            best = worth.argmax(1) if worth.shape[1] else np.zeros(len(live), int)
            ok = fits[np.arange(len(live)), best] if worth.shape[1] else np.zeros(len(live), bool)
            live, rows, best, to = live[ok], rows[ok], best[ok], to[ok]
            if not len(live):
                break
            rows[np.arange(len(live)), best] = to[np.arange(len(live)), best]
            take = np.minimum(columns[None, :] + (columns[None, :] > best[:, None]), symbols.shape[1] - 1)
            rows = np.take_along_axis(rows, take, 1)
            rows[:, -1] = -1
            symbols[live] = rows
        return symbols

    def _forget(self) -> None:
        self.seam_keys, self.seam_open = np.full(1, -1, np.int64), np.zeros(1, bool)
        self.slot_key, self.slot_open = np.full(SEAM_SLOTS, -1, np.int64), np.zeros(SEAM_SLOTS, bool)

    def seams(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the merge order leaves the two pieces of each pair apart.

        Slots hold the answers last used; behind them stand all known ones."""
        keys = left.astype(np.int64) * len(self.size) + right
        slot = ((keys.astype(np.uint64) * _U(_STEP)) >> _U(64 - SEAM_BITS)).astype(np.int64)
        out = self.slot_open[slot]
        miss = np.flatnonzero(self.slot_key[slot] != keys)
        if len(miss):
            out[miss] = self._known(keys[miss])
            self.slot_key[slot[miss]], self.slot_open[slot[miss]] = keys[miss], out[miss]
        return out

    def _known(self, keys: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.seam_keys, keys), len(self.seam_keys) - 1)
        new = np.unique(keys[self.seam_keys[at] != keys])
        if len(new):
            if len(self.seam_keys) > SEAMS_KEPT:
                self._forget()
                new = np.unique(keys)
            where = np.searchsorted(self.seam_keys, new)
            fine = self._apart(new // len(self.size), new % len(self.size))
            self.seam_keys = np.insert(self.seam_keys, where, new)
            self.seam_open = np.insert(self.seam_open, where, fine)
            at = np.searchsorted(self.seam_keys, keys)
        return self.seam_open[at]

    def _apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merges the characters of each pair and compares."""
        width = int((self.size[a] + self.size[b]).max())
        text = np.zeros((len(a), width + 1), np.uint32)
        for part, start in ((a, np.zeros(len(a), np.int64)), (b, self.size[a])):
            for k in range(int(self.size[part].max())):
                own = np.flatnonzero(self.size[part] > k)
                text[own, start[own] + k] = self.chars[part[own], k]
        out = self.merged(np.where(text > 0, self.of_char[text], -1))
        return (out[:, 0] == a) & (out[:, 1] == b) & (out[:, 2] < 0)


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(max(n - 1, 0), base, np.uint64))), dtype=np.uint64)


def _prefix_hashes(chars: np.ndarray) -> np.ndarray:
    """Rows x (length + 1): hash of the first k characters."""
    x = (chars.astype(np.uint64) + _U(1)) * _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    x *= _U(0xD6E8FEB86659FD93)
    out = np.zeros((chars.shape[0], chars.shape[1] + 1), np.uint64)
    np.cumsum(x * _powers(_STEP, chars.shape[1])[None, :], axis=1, dtype=np.uint64, out=out[:, 1:])
    return out


def load(path: str) -> tuple:
    """Arguments of :class:`Pieces` from a model file, read on the driver.

    Models whose normaliser changes characters or that put the mark behind
    words are refused: this encoder does not normalise."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    rule, spec = model.normalizer_spec, model.trainer_spec
    if rule.precompiled_charsmap or rule.remove_extra_whitespaces or not rule.add_dummy_prefix or spec.treat_whitespace_as_suffix:
        raise ValueError(f"{path}: only models that leave characters and spaces as they are and mark word starts")
    if spec.model_type not in (1, 2):
        raise ValueError(f"{path}: neither a unigram nor a BPE model")
    own = [p.piece if p.type == 1 else "" for p in model.pieces]
    if any(MARK in p.lstrip(MARK) for p in own):
        raise ValueError(f"{path}: pieces reach over word starts")
    chars = np.zeros((len(own), max(map(len, own))), np.uint32)
    for i, p in enumerate(own):
        chars[i, : len(p)] = [ord(c) for c in p]
    byte, raw, unknown = np.full(256, -1, np.int32), [], 0
    for i, p in enumerate(model.pieces):
        if p.type == 6:
            byte[int(p.piece[3:5], 16)] = i
            raw.append(bytes([int(p.piece[3:5], 16)]))
        else:
            unknown = i if p.type == 2 else unknown
            raw.append(own[i].replace(MARK, " ").encode() if p.type == 1 else " ⁇ ".encode() if p.type == 2 else b"")
    size = np.array([len(p) for p in own], np.int64)
    score = np.array([p.score for p in model.pieces], np.float64)
    return chars, size, score, byte, raw, spec.model_type == 2, unknown


def _kept(value: dict) -> Pieces:
    """The table of this worker process; tasks that share the broadcast value
    share it, with the seams known so far."""
    if "table" not in value:
        value["table"] = Pieces(*value["model"])
    return value["table"]


def solve(chars: np.ndarray, table: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Viterbi over rows of known characters, all of the same length.

    Returns (ids, row of each id), ids in order within a row."""
    n, length = chars.shape
    hashes, inverse = _prefix_hashes(chars), _powers(_STEP_INV, length + 1)
    most = min(table.longest, length)
    ids = np.full((n, length + 1, most), -1, np.int32)  # piece that ends at i, of k + 1 characters
    for k in range(most):
        ids[:, k + 1 :, k] = table.find((hashes[:, k + 1 :] - hashes[:, : length - k]) * inverse[None, : length - k])
    best = np.full((n, length + 1), -np.inf)
    best[:, 0] = 0
    last = np.full((n, length + 1), -1, np.int32)
    back = np.zeros((n, length + 1), np.int32)
    for i in range(1, length + 1):
        m = min(most, i)
        ways = ids[:, i, :m]
        before = best[:, i - m : i][:, ::-1]
        row, k = np.nonzero((ways >= 0) & (before > -np.inf))
        worth = np.full((n, m), -np.inf)
        if table.merges:
            a, b = last[row, i - 1 - k], ways[row, k]
            ok = a < 0
            ok[~ok] = table.seams(a[~ok], b[~ok])
            row, k = row[ok], k[ok]
        worth[row, k] = before[row, k] + table.score[ways[row, k]]
        take = worth.argmax(1)
        best[:, i] = worth[np.arange(n), take]
        last[:, i] = ways[np.arange(n), take]
        back[:, i] = take + 1
    odd = np.isneginf(best[:, length])
    at, ids_out, rows_out, live = np.full(n, length), [], [], np.flatnonzero(~odd)
    while len(live):
        ids_out.append(last[live, at[live]])
        rows_out.append(live)
        at[live] -= back[live, at[live]]
        live = live[at[live] > 0]
    if odd.any():
        own = np.flatnonzero(odd)
        straight = table.merged(np.concatenate((table.of_char[chars[own]], np.full((len(own), 1), -1, np.int32)), 1))[:, ::-1]
        for column in straight.T:
            ok = column >= 0
            ids_out.append(column[ok])
            rows_out.append(own[ok])
    got, rows = np.concatenate(ids_out)[::-1], np.concatenate(rows_out)[::-1]
    order = np.argsort(rows, kind="stable")
    return got[order], rows[order]


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions start .. start + size - 1 of every row, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def encode_batch(texts: list[str], table: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts one after another, ids of each text)."""
    marked = [MARK + t.replace(" ", MARK) if t else "" for t in texts]
    points = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    sizes = np.array([len(t) for t in marked], np.int64)
    if not len(points):
        return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
    first = np.zeros(len(points) + 1, bool)
    first[np.cumsum(sizes) - sizes] = True
    is_mark = points == ord(MARK)
    known = table.known[points]
    # Units start at text starts, at the last mark of a run, at and behind unknown characters.
    more = np.concatenate((is_mark[1:] & ~first[1:-1], [False]))  # the next one is a mark of the same text
    extra = is_mark & more
    begins = first[:-1] | (is_mark & ~more) | ~known
    begins[1:] |= ~known[:-1] | extra[:-1]
    begins |= is_mark & ~np.concatenate(([False], is_mark[:-1]))
    # Marks before the last of a run are counted with the unit behind them.
    begins &= ~extra
    runs = np.cumsum(extra)
    start = np.flatnonzero(begins)
    stop = np.concatenate((start[1:], [len(points)]))
    spare = np.diff(np.concatenate(([0], runs[start])))
    # The marks of the following run stand behind a unit's own characters.
    stop = stop - np.concatenate((spare[1:], [0]))
    length = stop - start
    hashes = _prefix_hashes(points[None, :])[0]
    power = _powers(_STEP_INV, len(points) + 1)
    key = (hashes[stop] - hashes[start]) * power[start] + spare.astype(np.uint64) * _U(0xA24BAED4963EE407) + length.astype(np.uint64)
    _, pick, inverse = np.unique(key, return_index=True, return_inverse=True)
    u_start, u_len, u_spare = start[pick], length[pick], spare[pick]
    u_known = known[u_start]
    parts_ids, parts_unit = [], []
    for size in np.unique(u_len[u_known]):
        own = np.flatnonzero(u_known & (u_len == size))
        step = max(1, (1 << 20) // (int(size) * min(int(size), table.longest)))
        for a in range(0, len(own), step):
            block = own[a : a + step]
            ids, rows = solve(points[u_start[block][:, None] + np.arange(size)[None, :]].astype(np.uint32), table)
            parts_ids.append(ids)
            parts_unit.append(block[rows])
    for u in np.flatnonzero(~u_known):
        raw = chr(points[u_start[u]]).encode("utf-8", "surrogatepass")
        ids = table.byte[list(raw)]
        parts_ids.append(ids if (ids >= 0).all() else np.array([table.unknown], np.int32))
        parts_unit.append(np.full(len(parts_ids[-1]), u))
    ids, unit = np.concatenate(parts_ids), np.concatenate(parts_unit)
    order = np.argsort(unit, kind="stable")
    ids, count = ids[order].astype(np.int32), np.bincount(unit, minlength=len(pick))
    at = np.cumsum(count) - count
    if (u_spare > 0).any():
        pieces = [ids[a : a + c] for a, c in zip(at, count)]
        top = max(table.run_ids)
        for u in np.flatnonzero(u_spare > 0):
            run, rest = int(u_spare[u]), pieces[u]
            if len(rest) and rest[0] == table.mark_id:
                run, rest = run + 1, rest[1:]
            head = [top] * (run // top) + ([run % top] if run % top else [])
            pieces[u] = np.concatenate((np.array([table.run_ids[r] for r in head], np.int32), rest))
        count = np.array([len(p) for p in pieces])
        ids, at = np.concatenate(pieces).astype(np.int32), np.cumsum(count) - count
    out = ids[_ragged(at[inverse], count[inverse])]
    text_of = np.searchsorted(np.cumsum(sizes), start, "right")
    return out, np.bincount(text_of, weights=count[inverse], minlength=len(texts)).astype(np.int64)


def decode_batch(ids: np.ndarray, counts: np.ndarray, table: Pieces) -> list[str]:
    """Texts of the id runs; the first mark of a text is dropped."""
    raw = table.raw_bytes[_ragged(table.raw_start[ids], table.raw_size[ids])].tobytes()
    stops = np.concatenate(([0], np.cumsum(table.raw_size[ids])))[np.concatenate(([0], np.cumsum(counts)))]
    texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(stops[:-1], stops[1:])]
    return [t[1:] if t[:1] == " " else t for t in texts]


def _slices(texts: list, limit: int) -> Iterator[list]:
    own, size = [], 0
    for t in texts:
        own.append(t)
        size += len(t or "") + 1
        if size >= limit:
            yield own
            own, size = [], 0
    if own:
        yield own


def encode(docs: DataFrame, model_path: str, text: str = "text", verify: bool = True) -> DataFrame:
    """``docs`` without ``text``, with ``ids`` and, if ``verify``, ``round_trip``
    (whether decoding the ids gives the text). Clashing columns are replaced."""
    new = ["ids", "round_trip"] if verify else ["ids"]
    kept = [f for f in docs.schema.fields if f.name != text and f.name not in new]
    shared = docs.sparkSession.sparkContext.broadcast({"model": load(model_path)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _kept(shared.value)
        for b in batches:
            texts, ids, counts, right = b.column(text).to_pylist(), [], [], []
            for part in _slices(texts, BATCH_CHARS):
                got, n = encode_batch([t or "" for t in part], table)
                ids.append(got)
                counts.append(n)
                if verify:
                    right += [t is None or t == d for t, d in zip(part, decode_batch(got, n, table))]
            offsets = np.concatenate(([0], np.cumsum(np.concatenate([*counts, np.zeros(0, np.int64)])))).astype(np.int32)
            null = pa.array([t is None for t in texts])
            values = pa.array(np.concatenate([*ids, np.zeros(0, np.int32)]))
            lists = pa.ListArray.from_arrays(pa.array(offsets), values, mask=null)
            extra = [lists, pa.array(right, pa.bool_())] if verify else [lists]
            yield pa.RecordBatch.from_arrays([*[b.column(f.name) for f in kept], *extra], [*[f.name for f in kept], *new])

    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["ids array<int>"] + ["round_trip boolean"] * verify
    return docs.mapInArrow(run, ", ".join(types))


def decode(tokens: DataFrame, model_path: str, ids: str = "ids") -> DataFrame:
    """``tokens`` without ``ids``, with ``text`` (null ids: null)."""
    kept = [f for f in tokens.schema.fields if f.name not in (ids, "text")]
    shared = tokens.sparkSession.sparkContext.broadcast({"model": load(model_path)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _kept(shared.value)
        for b in batches:
            lists = b.column(ids).to_pylist()
            counts = np.array([len(x or ()) for x in lists], np.int64)
            flat = np.fromiter((i for x in lists for i in x or ()), np.int64, int(counts.sum()))
            texts = [None if x is None else t for x, t in zip(lists, decode_batch(flat, counts, table))]
            yield pa.RecordBatch.from_arrays([*[b.column(f.name) for f in kept], pa.array(texts, pa.string())], [*[f.name for f in kept], "text"])

    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["text string"]
    return tokens.mapInArrow(run, ", ".join(types))
