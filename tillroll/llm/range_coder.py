"""Adaptive context-mixing range coder for token ids, in numpy lanes.

A block of BLOCK ids starts from nothing, can be decoded alone and carries a checksum. It
is cut into lanes of STEPS ids, which are coded in step: one id of each lane at a time, by
a model that all lanes share and that learns from all of them after each step.

Tables keyed by the last two ids and by the last id each propose an id with a confidence.
How likely a proposal is, is mixed from all orders: order 2 and order 1 by their
confidence, order 0 by the frequency of the proposed id so far, each as the logarithm of
the odds that such predictions had until now, weighted by weights that follow the error.
An id that is not proposed is coded by order 0, without the ids proposed in vain. All that
decides is whole numbers, or sums and products that every machine rounds alike.

A block names the ids it holds once and codes their numbers among these, so that tables
are as large as the block's own alphabet.
"""

from __future__ import annotations

import math
import zlib

import numpy as np

from tillroll.llm.common import flat_ranges, offsets

#: Ids of a block, and of a lane of it.
BLOCK = 1 << 20
STEPS = 256
#: Ids have to be below this.
ID_LIMIT = 1 << 22

_U = np.uint64
_WORD, _BOTTOM = _U(32), _U(1 << 32)
#: Parts of a proposal's probability, and of an order-0 distribution.
_PARTS, _SLOTS = 1 << 12, 1 << 24
#: Slots, as a power of two, of which the first one's id is kept.
_RUN = 9
#: What an id has and gains in order 0, of which it always keeps at least a slot.
_FIRST, _GAIN = 1, 7
#: Confidences of orders 2 and 1, whether they propose the same, and sizes of a frequency.
_SURE, _LEVELS = 8, 16
_STATES = (_SURE, 2 * _SURE, _LEVELS)
_STATE = _SURE * 2 * _SURE * _LEVELS
_WIDTH = (1 << 26) - 1
#: Logarithms of odds are held in parts of 1 / 256.
_UNIT = 256


def _steps_of_update(steps: int) -> np.ndarray:
    """After which steps the shared statistics are renewed: soon at first, then every 16."""
    early = [n for n in (1, 2, 3, 4, 6, 8, 12) if n < steps]
    due = np.zeros(steps + 1, bool)
    due[early] = True
    due[16::16] = True
    return due


_STRETCH = np.array([0] + [round(_UNIT * math.log(p / (_PARTS - p))) for p in range(1, _PARTS)])
_FAR = 8 * _UNIT
_SQUASH = np.array([round(_PARTS / (1 + math.exp(-x / _UNIT))) for x in range(-_FAR, _FAR + 1)]).clip(16, _PARTS - 16)


class _Mixer:
    """The probability that a proposal of order 2, and of order 1, is right, by the states
    of the three orders; none where ``valid`` says so. Order 2 comes first in all arrays."""

    def __init__(self):
        sure2, alike, sure1 = np.arange(_SURE)[:, None, None], np.arange(2 * _SURE)[:, None] >> 3, np.arange(2 * _SURE)[:, None] & 7
        self.valid = np.zeros((2, *_STATES), np.int64)
        self.valid[0] = sure2 > 0
        self.valid[1] = (sure1 > 0) & (alike == 0)  # what order 2 proposes too is tried once
        self.tried = [np.full((2, size), 2, np.int64) for size in _STATES]
        self.right = [np.full((2, size), 1, np.int64) for size in _STATES]
        # One set of weights for each confidence of order 2; all orders count alike at first.
        self.weights = np.full((3, 2, _SURE), 0.4)
        self._mix()

    def _mix(self) -> None:
        self.logs = []
        for axis, (tried, right) in enumerate(zip(self.tried, self.right)):
            odds = _STRETCH[((2 * right + 1) * _PARTS // (2 * tried + 2)).clip(8, _PARTS - 8)]
            self.logs.append(odds.reshape([2, *(-1 if a == axis else 1 for a in range(3))]))
        whole = np.rint(self.weights * 65536).astype(np.int64)
        mixed = sum(w[..., None, None] * logs for w, logs in zip(whole, self.logs)) >> 16
        self.table = (_SQUASH[mixed.clip(-_FAR, _FAR) + _FAR] * self.valid).ravel()

    def update(self, seen: np.ndarray) -> None:
        """Learns from how often each state was seen with a wrong proposal, and with a right
        one: the counts of each order's states, then the weights."""
        wrong, right = seen.reshape(2, *self.valid.shape) * self.valid
        tried = wrong + right
        error = right * _PARTS - tried * self.table.reshape(self.valid.shape)
        n = tried.sum(axis=(2, 3))
        for axis, logs in enumerate(self.logs):
            slope = (error * logs).sum(axis=(2, 3))
            self.weights[axis] += 0.5 * slope / ((n + 64) * float(_PARTS * _UNIT))
            others = tuple(a + 1 for a in range(3) if a != axis)
            self.tried[axis] += tried.sum(axis=others)
            self.right[axis] += right.sum(axis=others)
        self._mix()


class _Model:
    """What encoder and decoder both know of a block, whose ids are numbered from 1; 0 is
    none. Order 2 is the first row of what has two."""

    def __init__(self, lanes: int, steps: int, alphabet: int):
        size = 1 << max(10, min(20, (lanes * steps).bit_length()))
        self.mask = size - 1
        self.one = np.zeros(alphabet + 1, np.int64)  # id << 3 | confidence
        self.two = np.zeros(size, np.uint16 if alphabet + 1 << 3 < 1 << 16 else np.int32)
        self.last = np.zeros(lanes, np.int64)
        self.before = np.zeros(lanes, np.int64)
        self.entries = np.zeros((2, lanes), np.int64)
        self.counts = np.full(alphabet + 1, _FIRST, np.int64)
        self.counts[0] = 0
        self.mixer = _Mixer()
        self.due = _steps_of_update(steps)
        self.step, self.fresh, self.notes = 0, [], []
        self._distribute()

    def _distribute(self) -> None:
        # Products of floats that hold whole numbers: rounded alike everywhere. At least a
        # slot each, as all counts together stay below the number of slots.
        ends = np.cumsum(self.counts)
        self.starts = np.zeros(len(ends) + 1, np.int64)
        self.starts[1:] = ends * (_SLOTS / float(ends[-1]))
        self.starts[-1] = _SLOTS
        widths = np.diff(self.starts)
        exponents = (widths.astype(np.float64).view(np.int64) >> 52) - 1023
        self.levels = (exponents - 8).clip(0, _LEVELS - 1)
        self.symbols = self.starts[:-1] << 26 | widths  # an id's start and width in one number
        self.first = None

    def predict(self) -> None:
        """The proposals of both orders, and the widths of their intervals in 2^24 parts."""
        self.at2 = (self.last * 2654435761 + self.before * 2246822519 >> 9) & self.mask
        self.entries[0] = self.two[self.at2]
        self.one.take(self.last, out=self.entries[1], mode="clip")
        self.proposed, self.sure = self.entries >> 3, self.entries.astype(np.int8) & np.int8(7)
        self.alike = self.proposed[0] == self.proposed[1]
        state = self.sure.astype(np.int16)
        state = (state[0] << 8) + (self.alike.astype(np.int16) << 7) + (state[1] << 4)
        self.states = self.levels.take(self.proposed, mode="clip") + state
        self.states[1] += _STATE
        self.chance = self.mixer.table.take(self.states, mode="clip")
        self.wide2 = (self.chance[0] << 12).view(_U)
        self.wide1 = ((_PARTS - self.chance[0]) * self.chance[1]).view(_U)

    def vain(self, at: np.ndarray) -> np.ndarray:
        """What both orders have proposed in vain to the lanes ``at``: start and width in order 0, zero where nothing was."""
        vain = np.empty((2, len(at)), np.int64)
        vain[0] = self.symbols[self.proposed[0][at]]
        np.multiply(self.symbols[self.proposed[1][at]], ~self.alike[at], out=vain[1])
        return vain

    def at_slots(self, slots: np.ndarray) -> np.ndarray:
        """The ids of these slots of order 0: by the first id of each run of slots, mostly the one or the next."""
        if self.first is None:
            begun = np.bincount((self.starts[1:-1] - 1 >> _RUN) + 1, minlength=(_SLOTS >> _RUN) + 1)
            self.first = np.cumsum(begun)[: _SLOTS >> _RUN]
        found = self.first[slots >> _RUN]
        beyond = slots >= self.starts[found + 1]
        found += beyond
        at = np.flatnonzero(beyond)
        at = at[slots[at] >= self.starts[found[at] + 1]]
        found[at] = np.searchsorted(self.starts, slots[at], side="right") - 1
        return found

    def learn(self, ids: np.ndarray, right: np.ndarray) -> None:
        """``right``: which proposals were ``ids``."""
        note = self.states + (right.astype(np.int16) << 12)
        note[1] *= ~right[0]  # not tried: noted where nothing is valid
        self.notes.append(note)
        # A right proposal gains confidence, a wrong one loses half or, unsure, is replaced.
        sure, held = self.sure, right.view(np.int8)
        loss = sure + np.int8(1) >> 1
        self.entries += ((sure < 7) + loss) * held - loss
        self.entries += ((ids << 3 | 1) - self.entries) * (~right & (sure < 2))
        self.two[self.at2] = self.entries[0].astype(self.two.dtype)
        self.one[self.last] = self.entries[1]
        self.before, self.last = self.last, ids
        self.fresh.append(ids)
        self.step += 1
        if self.due[self.step]:
            self.counts += _GAIN * np.bincount(np.concatenate(self.fresh), minlength=len(self.counts))
            seen = np.bincount(np.concatenate(self.notes, axis=None), minlength=4 * _STATE)
            self.fresh, self.notes = [], []
            self._distribute()
            self.mixer.update(seen)


# The interval of a lane narrows within 64 bits. Once it is below 32 of them its upper
# word is written: it is settled, or the interval is cut where it would change. Lanes
# that missed narrow theirs a second time, in order 0; the others have no part in that.


def _narrowed(low: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return low << _WORD, np.minimum(span, _BOTTOM - (low & (_BOTTOM - _U(1)))) << _WORD


class _Encoder:
    def __init__(self, lanes: int):
        self.low, self.range = np.zeros(lanes, _U), np.full(lanes, 2**64 - 1, _U)
        self.lanes, self.words = [], []

    def _write(self, low: np.ndarray, span: np.ndarray, lanes: np.ndarray | None = None) -> None:
        """Writes a word of those of ``lanes``, or of all, whose interval is small."""
        if len(at := np.flatnonzero(span < _BOTTOM)):
            some = low[at]
            self.lanes.append((at if lanes is None else lanes[at]).astype(np.uint16))
            self.words.append((some >> _WORD).astype("<u4"))
            low[at], span[at] = _narrowed(some, span[at])

    def put(self, model: _Model, ids: np.ndarray, right: np.ndarray, hit1: np.ndarray) -> None:
        parts = self.range >> _U(24)
        first, second = parts * model.wide2, parts * model.wide1
        at = np.flatnonzero(~(right[0] | hit1))
        end = first[at] + second[at]
        low, span = self.low[at] + end, (parts[at] << _U(24)) - end
        self._write(low, span, at)
        symbol, vain = model.symbols[ids[at]], model.vain(at)
        wide = vain & _WIDTH
        parts = span // (_SLOTS - wide[0] - wide[1]).view(_U)
        wide *= vain < symbol
        low += parts * ((symbol >> 26) - wide[0] - wide[1]).view(_U)
        self.low += first * hit1
        self.range = first + (second - first) * hit1
        self.low[at], self.range[at] = low, parts * (symbol & _WIDTH).view(_U)
        self._write(self.low, self.range)

    def finish(self) -> tuple[np.ndarray, bytes]:
        """Words of each lane, and all of them. The last is the one that, with zeros behind, lies inside."""
        self.lanes.append(np.arange(len(self.low), dtype=np.uint16))
        self.words.append((self.low + (_BOTTOM - _U(1)) >> _WORD).astype("<u4"))
        lanes = np.concatenate(self.lanes)
        return np.bincount(lanes), np.concatenate(self.words)[np.argsort(lanes, kind="stable")].tobytes()


class _Decoder:
    def __init__(self, n: np.ndarray, words: np.ndarray):
        # Two more words of each lane, zeros, are read.
        self.at = offsets(n + 2)[:-1]
        self.words = np.zeros(int(n.sum()) + 2 * len(n), _U)
        self.words[flat_ranges(self.at, n)] = words
        self.low, self.range = np.zeros(len(n), _U), np.full(len(n), 2**64 - 1, _U)
        self.code = self.words[self.at] << _WORD | self.words[self.at + 1]  # less ``low``
        self.at += 2

    def _read(self, low: np.ndarray, span: np.ndarray, code: np.ndarray, lanes: np.ndarray | None = None) -> None:
        """Reads a word for those of ``lanes``, or for all, whose interval is small."""
        if len(at := np.flatnonzero(span < _BOTTOM)):
            own = at if lanes is None else lanes[at]
            place = self.at[own]
            code[at] = code[at] << _WORD | self.words[place]
            self.at[own] = place + 1
            low[at], span[at] = _narrowed(low[at], span[at])

    def take(self, model: _Model) -> np.ndarray:
        parts = self.range >> _U(24)
        first, second = parts * model.wide2, parts * model.wide1
        end = first + second
        proposed = self.code < end
        hit1 = proposed & (self.code >= first)
        at = np.flatnonzero(~proposed)
        end = end[at]
        low, span, code = self.low[at] + end, (parts[at] << _U(24)) - end, self.code[at] - end
        self._read(low, span, code, at)
        vain = model.vain(at)
        wide = vain & _WIDTH
        total = _SLOTS - wide[0] - wide[1]
        parts = span // total.view(_U)
        slot = np.minimum((code // parts).view(np.int64), total - 1)
        # Slots of order 0 again: the lower of the two proposals first.
        for gap in (np.minimum(vain[0], vain[1]), np.maximum(vain[0], vain[1])):
            slot += (gap & _WIDTH) * (slot >= gap >> 26)
        found = model.at_slots(slot)
        symbol = model.symbols[found]
        wide *= vain < symbol
        start = parts * ((symbol >> 26) - wide[0] - wide[1]).view(_U)
        ids = model.proposed[0] + (model.proposed[1] - model.proposed[0]) * hit1
        ids[at] = found
        before = first * hit1
        self.low += before
        self.code -= before
        self.range = first + (second - first) * hit1
        self.low[at], self.range[at], self.code[at] = low + start, parts * (symbol & _WIDTH).view(_U), code - start
        self._read(self.low, self.range, self.code)
        return ids


def _shape(n: int) -> tuple[int, int]:
    """Lanes of a block of ``n`` ids, and steps of each."""
    lanes = -(-n // STEPS)
    return lanes, -(-n // lanes)


def _packed(ids: np.ndarray) -> bytes:
    lanes, steps = _shape(len(ids))
    ids = ids.astype(np.int64)
    held = np.zeros(int(ids.max()) + 1, bool)
    held[ids] = True
    alphabet = np.flatnonzero(held)
    columns = np.ones((lanes, steps), np.int32)
    columns.ravel()[: len(ids)] = np.cumsum(held, dtype=np.int32)[ids]
    model, coder = _Model(lanes, steps, len(alphabet)), _Encoder(lanes)
    for now in np.ascontiguousarray(columns.T):
        now = now.astype(np.int64)
        model.predict()
        right = model.proposed == now
        coder.put(model, now, right, right[1] & ~model.alike)
        model.learn(now, right)
    sizes, words = coder.finish()
    # Number of ids and bytes of their gaps, these, and each lane's words.
    gaps = zlib.compress(np.diff(alphabet, prepend=0).astype("<u4").tobytes())
    head = np.array([len(alphabet), len(gaps)], "<u4").tobytes() + gaps + bytes(-len(gaps) % 4)
    return head + np.append(sizes, [0] * (lanes % 2)).astype("<u2").tobytes() + words


def _unpacked(n: int, words: np.ndarray) -> np.ndarray:
    lanes, steps = _shape(n)
    n_held, size = int(words[0]), int(words[1])
    head = 2 + -(-size // 4)
    if not 0 < n_held <= n:
        raise IndexError(n_held)
    gaps = zlib.decompressobj().decompress(words[2:head].tobytes()[:size], 4 * n_held)
    alphabet = np.append(0, np.cumsum(np.frombuffer(gaps, "<u4", n_held), dtype="<u4")).astype("<u4")
    sizes = words[head : head + (lanes + 1) // 2].view("<u2")[:lanes].astype(np.int64)
    block = np.zeros((steps, lanes), np.int32)
    model, coder = _Model(lanes, steps, n_held), _Decoder(sizes, words[head + (lanes + 1) // 2 :])
    for row in block:
        model.predict()
        now = coder.take(model)
        model.learn(now, model.proposed == now)
        row[:] = now
    return alphabet[np.ascontiguousarray(block.T).reshape(-1)[:n]]


def compress(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, bytes]:
    """(32-bit words of each block, crc32 of each block's ids, payload) of ids below ID_LIMIT."""
    if len(ids) and not 0 <= int(ids.min()) <= int(ids.max()) < ID_LIMIT:
        raise ValueError(f"ids have to be from 0 to {ID_LIMIT - 1}")
    blocks = [ids[k : k + BLOCK] for k in range(0, len(ids), BLOCK)]
    payloads = [_packed(block) for block in blocks]
    sizes = np.array([len(p) // 4 for p in payloads], np.int64)
    crcs = np.array([zlib.crc32(block.astype("<u4").tobytes()) for block in blocks], np.int64)
    return sizes, crcs, b"".join(payloads)


def decompress(n: int, sizes: np.ndarray, crcs: np.ndarray, payload: bytes) -> np.ndarray:
    """The ``n`` ids of :func:`compress`; a block whose checksum differs is an error."""
    words = np.frombuffer(payload, "<u4")
    ends = np.cumsum(np.asarray(sizes, np.int64))
    made = [np.zeros(0, "<u4")]
    for k, (size, end, crc) in enumerate(zip(sizes, ends, crcs)):
        try:
            with np.errstate(divide="ignore"):
                ids = _unpacked(min(n - k * BLOCK, BLOCK), words[end - size : end])
        except (IndexError, ValueError, zlib.error):  # what is damaged may point anywhere
            ids = made[0]
        if zlib.crc32(ids.tobytes()) != crc:
            raise ValueError(f"block {k} is damaged: its checksum differs")
        made.append(ids)
    return np.concatenate(made)
