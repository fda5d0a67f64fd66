"""Adaptive context-mixing range coder for token ids.

Ids are cut into blocks that are coded independently: every block starts from an empty model
and carries its number of ids and their CRC-32.  All blocks of a call advance together, one id
a step, with one numpy lane a block; models, arithmetic and buffers are integer arrays over the
lanes, so encoder and decoder stay in step on any machine.

For each id an order-2 table (by the two ids before) and an order-1 table (by the one before)
each predict an id, with a confidence that grows with every hit.  The deeper table that knows
its context names the candidate.  How often such a confidence was right so far, of order 2, of
order 1 and overall (order 0), gives three probabilities, which a logistic mixer with learned
weights combines; a binary decision "candidate or not" is coded with the result.  A missed id
follows by nibbles: the adaptive order-0 distributions of the first three, given the nibbles
before, and an even one for the rest.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK = 4096          # ids a block
MAGIC = b"IDS1"
SLOTS = 12            # bits of a context table's index
FLAG_BITS, NIBBLE_BITS = 12, 12
MAX_CONFIDENCE = 15
CONFIDENCE_BITS = 4
_TOP = 1 << 32


def _squash_table() -> np.ndarray:
    x = np.arange(-2048, 2048) / 256.0
    return np.clip(np.round(4096 / (1 + np.exp(-x))), 16, 4080).astype(np.int32)


_SQUASH = _squash_table()
#: logit of a 12-bit probability in units of 1/256
_STRETCH = np.clip(np.round(256 * np.log((np.arange(4096) + 0.5) / (4095.5 - np.arange(4096)))), -2047, 2047).astype(np.int32)
#: what a nibble's 16 lower bounds move towards, by the nibble seen (the first stays 0)
_TARGET = np.array([[(4096 - 16) * (i > s) + i for i in range(16)] for s in range(16)], np.int16)
_EVEN = (np.arange(16) * 256).astype(np.int16)


class _Model:
    """State of all lanes.  A cell of the two context tables is an id and its confidence, in one number."""

    def __init__(self, lanes: int):
        n = 1 << SLOTS
        self.table = np.zeros(2 * lanes * n, np.uint32)
        self.base = (np.arange(lanes) << SLOTS) + np.array([[0], [lanes * n]])
        self.hit = np.tile(np.concatenate([np.linspace(600, 3500, 16), np.linspace(600, 3500, 16),
                                           [1024]]).astype(np.int32), (lanes, 1)).ravel()
        self.orders = np.arange(lanes) * 33 + np.array([[16], [0], [32]])
        self.weight = np.full((3, lanes), 1 << 15, np.int32)
        self.nibble = [np.tile(_EVEN, (lanes * k, 1)) for k in (1, 16, 256)]
        self.one, self.two = np.zeros(lanes, np.uint32), np.zeros(lanes, np.uint32)

    def predict(self, a: int):
        """Candidate ids of the first ``a`` lanes and the probability (12 bits) of a hit."""
        one = self.one[:a]
        hashed = np.stack([one * np.uint32(0x9E3779B1), (one * np.uint32(0x85EBCA6B) + self.two[:a]) * np.uint32(0xC2B2AE35)])
        self.at = self.base[:, :a] + (hashed >> np.uint32(32 - SLOTS))
        self.cell = self.table.take(self.at)
        self.confidence = self.cell & np.uint32(MAX_CONFIDENCE)
        self.known = self.cell >> np.uint32(CONFIDENCE_BITS)
        (c1, c2), (i1, i2) = self.confidence, self.known
        candidate = np.where(c2 > 0, i2, i1)
        self.cells = self.orders[:, :a].copy()
        self.cells[0] += c1 * (i1 == candidate)
        self.cells[1] += c2
        self.hits = self.hit.take(self.cells)
        self.logits = _STRETCH.take(self.hits)
        part = self.weight[:, :a] * self.logits
        dot = (part[0] + part[1] + part[2]) >> 16
        self.p = _SQUASH.take(dot + 2048, mode="clip")
        return candidate, self.p

    def update(self, a: int, ids: np.ndarray, hit: np.ndarray) -> None:
        aim = hit * np.int32(4095)
        self.weight[:, :a] += (self.logits * (aim - self.p)) >> 11
        self.hit[self.cells] = self.hits + ((aim - self.hits) >> 5)
        c = self.confidence
        same = (self.known == ids) & (c > 0)
        less = self.cell - c + (c >> np.uint32(1))
        other = np.where(c < 2, ids << np.uint32(CONFIDENCE_BITS) | np.uint32(1), less)
        self.table[self.at] = np.where(same, self.cell + (c < MAX_CONFIDENCE), other)
        self.two[:a] = self.one[:a]
        self.one[:a] = ids


class _Encoder:
    """Coded words of all lanes; ``put`` works on the state of some of them (``low``, ``range``: all lanes')."""

    def __init__(self, lanes: int, ids: int):
        self.low, self.range = np.zeros(lanes, np.int64), np.full(lanes, _TOP - 1, np.int64)
        self.words, self.pos = np.zeros((lanes, ids + 16), np.uint16), np.zeros(lanes, np.int64)

    def room(self) -> None:
        """Room for the words of one more id in each lane."""
        if self.pos.max() + 8 > self.words.shape[1]:
            self.words = np.concatenate([self.words, np.zeros_like(self.words)], axis=1)

    def put(self, lane, low, r, start, freq, bits: int):
        """Code the interval ``start, freq`` of ``2 ** bits`` in each lane; their new ``low`` and range."""
        r = r >> bits
        low = low + r * start
        r *= freq
        over = (low >= _TOP).nonzero()[0]
        if len(over):
            self._carry(lane[over])
            low[over] -= _TOP
        short = (r < 1 << 16).nonzero()[0]
        if len(short):
            some = low.take(short)
            self._emit(lane.take(short), some >> 16)
            low[short] = (some & 0xFFFF) << 16
            r[short] <<= 16
        return low, r

    def _carry(self, lane) -> None:
        at = self.pos[lane] - 1
        while len(lane):
            self.words[lane, at] += np.uint16(1)
            again = self.words[lane, at] == 0
            lane, at = lane[again], at[again] - 1

    def _emit(self, lane, word) -> None:
        at = self.pos.take(lane)
        self.words.reshape(-1)[lane * self.words.shape[1] + at] = word
        self.pos[lane] = at + 1

    def finish(self) -> list[bytes]:
        every = np.arange(len(self.pos))
        self.room()
        self._emit(every, self.low >> 16)
        self._emit(every, self.low & 0xFFFF)
        return [w[:n].astype("<u2").tobytes() for w, n in zip(self.words, self.pos)]


class _Decoder:
    """Words of all lanes; ``value`` and ``take`` work on the state of some (``code``, ``range``: all lanes')."""

    def __init__(self, payloads: list[bytes]):
        longest = max(map(len, payloads)) // 2 + 2
        self.words = np.zeros((len(payloads), longest), np.uint16)
        for i, p in enumerate(payloads):
            self.words[i, :len(p) // 2] = np.frombuffer(p, "<u2")
        self.code = self.words[:, 0].astype(np.int64) << 16 | self.words[:, 1].astype(np.int64)
        self.range = np.full(len(payloads), _TOP - 1, np.int64)
        self.pos = np.full(len(payloads), 2, np.int64)

    @staticmethod
    def value(code, part, bits: int):
        # both are below 2**32, so the double nearest to the quotient has its whole part
        return np.minimum((code / part).astype(np.int64), (1 << bits) - 1)

    def take(self, lane, code, part, start, freq):
        code, r = code - part * start, part * freq
        short = (r < 1 << 16).nonzero()[0]
        if len(short):
            where = lane.take(short)
            at, width = self.pos.take(where), self.words.shape[1]
            word = self.words.reshape(-1).take(where * width + np.minimum(at, width - 1))
            code[short] = (code.take(short) << 16 | word) & (_TOP - 1)  # only a damaged payload has more bits
            r[short] <<= 16
            self.pos[where] = at + 1
        return code, r


def _nibbles(model: _Model, lane, bits: int, ids=None, encoder=None, decoder=None):
    """Code the ids of the lanes that missed (or return them, decoding)."""
    known = np.zeros(len(lane), np.int64)
    row = np.arange(len(lane)) << 4
    shift = bits
    low, r = (encoder.low if encoder else decoder.code).take(lane), (encoder or decoder).range.take(lane)
    for k, table in enumerate(model.nibble):
        shift -= 4
        at = lane * 16 ** k + known
        cdf = table.take(at, axis=0)
        if encoder:
            s = (ids >> shift) & 15
        else:
            part = r >> NIBBLE_BITS
            v = decoder.value(low, part, NIBBLE_BITS).astype(np.int16)
            below = np.bitwise_count((cdf <= v[:, None]).view(np.uint64))
            s = below[:, 0].astype(np.int64) + below[:, 1] - 1
        start = cdf.take(row + s).astype(np.int64)
        # the bound after a row's last one is the next row's first, 0, which stands for 4096
        freq = cdf.take(row + s + 1, mode="clip").astype(np.int64)
        freq = np.where(s < 15, freq, 1 << NIBBLE_BITS) - start
        if encoder:
            low, r = encoder.put(lane, low, r, start, freq, NIBBLE_BITS)
        else:
            low, r = decoder.take(lane, low, part, start, freq)
        table[at] = cdf + ((_TARGET.take(s, axis=0) - cdf) >> 4)
        known = known << 4 | s
    if encoder:
        encoder.low[lane], encoder.range[lane] = encoder.put(lane, low, r, ids & ((1 << shift) - 1), 1, shift)
        return ids
    part = r >> shift
    last = decoder.value(low, part, shift)
    decoder.code[lane], decoder.range[lane] = decoder.take(lane, low, part, last, 1)
    return known << shift | last


def encode(ids: np.ndarray, block: int = BLOCK) -> bytes:
    """A frame of independently coded blocks for an array of ids below 2 ** 24."""
    ids = np.asarray(ids, np.int64)
    bits = max(16, -(-int(ids.max(initial=0)).bit_length() // 4) * 4)
    if bits > 24:
        raise ValueError("ids of more than 24 bits")
    lanes = -(-len(ids) // block)
    sizes = [min(block, len(ids) - i * block) for i in range(lanes)]
    payloads = []
    if lanes:
        grid = np.zeros((lanes, block), np.int64)
        grid.ravel()[:len(ids)] = ids
        grid = np.ascontiguousarray(grid.T)
        model, out, lane = _Model(lanes), _Encoder(lanes, block), np.arange(lanes)
        for t in range(sizes[0]):
            a = lanes if t < sizes[-1] else lanes - 1
            now = grid[t, :a]
            candidate, p = model.predict(a)
            hit = candidate == now
            out.room()
            out.low[:a], out.range[:a] = out.put(lane[:a], out.low[:a], out.range[:a], np.where(hit, 0, p),
                                                 np.where(hit, p, (1 << FLAG_BITS) - p), FLAG_BITS)
            missed = np.flatnonzero(~hit)
            if len(missed):
                _nibbles(model, missed, bits, ids=now[missed], encoder=out)
            model.update(a, now.astype(np.uint32), hit)
        payloads = out.finish()
    head = [MAGIC, struct.pack("<BI", bits, lanes)]
    for i, (n, payload) in enumerate(zip(sizes, payloads)):
        crc = zlib.crc32(ids[i * block:i * block + n].astype("<u4").tobytes())
        head.append(struct.pack("<III", n, crc, len(payload)))
    return b"".join(head + payloads)


def decode(frame: bytes) -> np.ndarray:
    """The ids of a frame (uint32); ValueError if it is damaged."""
    if frame[:4] != MAGIC:
        raise ValueError("not a frame of coded ids")
    bits, lanes = struct.unpack_from("<BI", frame, 4)
    heads = [struct.unpack_from("<III", frame, 9 + 12 * i) for i in range(lanes)]
    if not lanes:
        return np.empty(0, np.uint32)
    at, payloads = 9 + 12 * lanes, []
    for _, _, size in heads:
        payloads.append(frame[at:at + size])
        at += size
    sizes = [n for n, _, _ in heads]
    grid = np.zeros((sizes[0], lanes), np.uint32)
    model, source, lane = _Model(lanes), _Decoder(payloads), np.arange(lanes)
    for t in range(sizes[0]):
        a = lanes if t < sizes[-1] else lanes - 1
        candidate, p = model.predict(a)
        part = source.range[:a] >> FLAG_BITS
        hit = source.value(source.code[:a], part, FLAG_BITS) < p
        source.code[:a], source.range[:a] = source.take(lane[:a], source.code[:a], part, np.where(hit, 0, p),
                                                        np.where(hit, p, (1 << FLAG_BITS) - p))
        now = candidate
        missed = np.flatnonzero(~hit)
        if len(missed):
            now[missed] = _nibbles(model, missed, bits, decoder=source)
        model.update(a, now, hit)
        grid[t, :a] = now
    for i, (n, crc, _) in enumerate(heads):
        if zlib.crc32(np.ascontiguousarray(grid[:n, i]).astype("<u4").tobytes()) != crc:
            raise ValueError(f"block {i} of a frame fails its checksum")
    return np.ascontiguousarray(grid.T).ravel()[:sum(sizes)]
