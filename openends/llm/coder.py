"""An adaptive context-mixing range coder for token ids, many blocks at a time.

A block is coded on its own: its model starts afresh, and it carries its number of ids
and a checksum. Blocks take their steps together as numpy lanes, one id of each at a time.

Three orders predict the next id. Order 2 remembers what last followed the two ids before,
order 1 what followed the id before; order 0 knows how often each id occurs in the file. An
adaptive mixture, chosen by how often the two memories were right lately, splits the
range among "order 2 is right", "order 1 is right" and "neither"; after "neither" the id follows
by order 0.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK = 4096
MAGIC = b"OEI2"
# Slots of the order-1 and order-2 memories of a block.
SLOTS_BITS = 12
# Order-0 counts are scaled to this total.
SCALE_BITS = 20
# Ids up to this many are ranked by a table, larger ones by sorting.
TABLE_IDS = 1 << 22
# Parts of the mixture are of 2^16; a step moves them by 1/2^MIX_SHIFT of what is missing, about FLOOR is left to each.
MIX_SHIFT, FLOOR = 6, 32
# The parts a block begins with: of order 2, and of order 1 in what it leaves, by how often each was right lately.
FIRST_TWO, FIRST_ONE = np.array([0.05, 0.4, 0.6, 0.8]), np.array([0.05, 0.2, 0.4, 0.6])
WORD, HIGH = np.uint64(32), np.uint64(1 << 32)
HASH, TURN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x1000193)
# A slot holds a rank and, in its last two bits, how often the rank was right lately.
EMPTY = np.uint32(0xFFFFFFFC)
UP = (65536 - 2 * FLOOR) >> MIX_SHIFT
KEEP = np.uint64(((0xFFFF >> MIX_SHIFT) << 16) | (0xFFFF >> MIX_SHIFT))
# What both bounds rise by when order 2, order 1 or neither was right.
RISE = np.array([UP << 16 | UP, UP << 16, 0], dtype=np.uint64)


class CorruptBlock(ValueError):
    """A block whose ids do not have the checksum written with it."""


def ranked(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct ids, how often each occurs, the place of every id among them)."""
    if ids.max() < TABLE_IDS:
        counts = np.bincount(ids)
        values = np.flatnonzero(counts)
        places = np.cumsum(counts > 0, dtype=np.uint32) - np.uint32(1)
        return values.astype(np.uint32), counts[values], places.take(ids)
    values, places, counts = np.unique(ids, return_inverse=True, return_counts=True)
    return values.astype(np.uint32), counts, places.astype(np.uint32)


def order_zero(counts: np.ndarray) -> np.ndarray:
    """Frequencies of total 2^SCALE_BITS, each at least 1."""
    total = 1 << SCALE_BITS
    if len(counts) >= total:
        raise ValueError("more distinct ids than the scale of frequencies holds")
    freq = np.maximum(1, counts * (total - len(counts)) // counts.sum()).astype(np.int64)
    freq[np.argmax(freq)] += total - freq.sum()
    return freq


def ranges(freq: np.ndarray) -> np.ndarray:
    """Where each rank starts in the scale (upper half) and its frequency (lower half)."""
    freq = freq.astype(np.uint64)
    return (np.cumsum(freq) - freq) << WORD | freq


def _start() -> np.ndarray:
    """The mixture by context; where both orders expect the same, order 1 has the least part."""
    two, one, same = np.meshgrid(np.arange(4), np.arange(4), np.arange(2), indexing="ij")
    first = FIRST_TWO[two]
    second = first + (1 - first) * np.where(same == 1, 0.0, FIRST_ONE[one])
    ends = np.clip([first * 65536, second * 65536], FLOOR, 65536 - 3 * FLOOR).astype(np.uint64)
    return (ends[1] << np.uint64(16) | ends[0]).ravel()


START = _start()


class Model:
    """The state of the lanes: memories of orders 1 and 2 and the mixture.

    The two orders are rows of one array, order 1 first. The mixture of a context is two
    bounds in one number: where "order 2 is right" ends, and, from bit 16 on, "order 1 is right".
    """

    def __init__(self, lanes: int):
        slots = 1 << SLOTS_BITS
        self.memory = np.full(2 * lanes * slots, EMPTY, dtype=np.uint32)
        self.mix = np.tile(START, lanes)
        lane = np.arange(lanes, dtype=np.uint64)
        self.slots = np.stack([2 * lane, 2 * lane + 1]) << np.uint64(SLOTS_BITS)
        self.contexts = lane.astype(np.uint32) * np.uint32(32)
        self.last = np.zeros((2, lanes), dtype=np.uint64)
        self.hashed = np.zeros((2, lanes), dtype=np.uint64)
        self.held = np.zeros((2, lanes), dtype=np.uint32)
        self.parts = np.zeros(lanes, dtype=np.uint64)

    def predict(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What both orders expect, and the ends of "order 2" and "order 1" in parts of 2^16."""
        np.multiply(self.last, HASH, out=self.hashed)
        self.hashed >>= np.uint64(64 - SLOTS_BITS)
        self.hashed += self.slots
        self.at = self.hashed.view(np.int64)
        held = self.memory.take(self.at, out=self.held, mode="clip")
        self.trust = held & np.uint32(3)
        self.guess = held >> np.uint32(2)
        context = self.trust[1] << np.uint32(3)
        context += self.trust[0] << np.uint32(1)
        context += self.guess[0] == self.guess[1]
        context += self.contexts
        self.context = context.astype(np.int64)
        self.mix.take(self.context, out=self.parts, mode="clip")
        return self.guess, self.parts & np.uint64(0xFFFF), (self.parts >> np.uint64(16)) + np.uint64(FLOOR)

    def update(self, now: np.ndarray, not_two: np.ndarray, neither: np.ndarray) -> None:
        moved = self.parts >> np.uint64(MIX_SHIFT)
        moved &= KEEP
        self.parts -= moved
        self.parts += RISE.take(not_two.view(np.uint8) + neither.view(np.uint8))
        self.mix[self.context] = self.parts
        right = self.guess == now
        again = right & (self.trust > 0)
        # trust: one more if right, up to 3, else half; without branches
        self.trust >>= np.uint32(1)
        self.trust += right
        self.trust += again
        self.trust |= now << np.uint32(2)
        self.memory[self.at] = self.trust
        np.multiply(self.last[0], TURN, out=self.last[1])
        self.last[1] += now
        self.last[0] = now


def split(
    wide: np.ndarray, two: np.ndarray, one: np.ndarray, not_two: np.ndarray, neither: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Where the chosen part of each lane's range begins, and its size. The masks are factors,
    as chance decides between the parts and a branch would be guessed wrong."""
    rest = wide - one
    one -= two
    start = two * not_two
    start += one * neither
    two *= ~not_two
    two += one * (not_two ^ neither)
    two += rest * neither
    return start, two


def encode(ids: np.ndarray) -> bytes:
    """One file: header, order-0 counts, then every block with its size and checksum."""
    ids = np.ascontiguousarray(ids, dtype=np.uint32)
    if not len(ids):
        return MAGIC + struct.pack("<QIII", 0, 0, 0, 0)
    values, counts, places = ranked(ids)
    freq = order_zero(counts)
    scale = ranges(freq)
    lanes, steps = -(-len(ids) // BLOCK), min(len(ids), BLOCK)
    places.resize(lanes * steps, refcheck=False)  # the last block is coded to its end with rank 0
    columns = np.ascontiguousarray(places.reshape(lanes, steps).T)
    del places
    model = Model(lanes)
    low = np.zeros(lanes, dtype=np.uint64)
    wide = np.full(lanes, (1 << 64) - 1, dtype=np.uint64)
    room = steps + 1  # a step moves out one word at most
    out = np.zeros(lanes * room, dtype=np.uint32)
    ends = np.arange(lanes) * room

    def carry(over: np.ndarray) -> None:
        """`low` of these lanes has passed 2^64: one more in the word before, and on where that becomes 0."""
        at = ends[over] - 1
        while len(at):
            out[at] += np.uint32(1)
            at = at[out[at] == 0] - 1

    for now in columns:
        guess, two, one = model.predict()
        unit = wide >> np.uint64(16)
        two *= unit
        one *= unit
        right = guess == now
        not_two = ~right[1]
        neither = not_two & ~right[0]
        add, wide = split(wide, two, one, not_two, neither)
        fresh = neither.nonzero()[0]
        part = scale.take(now.take(fresh))
        unit = wide.take(fresh) >> np.uint64(SCALE_BITS)
        add[fresh] += (part >> WORD) * unit
        wide[fresh] = (part & (HIGH - np.uint64(1))) * unit
        low += add
        carry((low < add).nonzero()[0])
        small = (wide < HIGH).nonzero()[0]
        if len(small):
            at = ends[small]
            head = low[small]
            out[at] = head >> WORD
            ends[small] = at + 1
            low[small] = head << WORD
            wide[small] <<= WORD
        model.update(now, not_two, neither)
    # The range holds a number whose last word is 0, which is not written.
    low += HIGH - np.uint64(1)
    carry((low < HIGH - np.uint64(1)).nonzero()[0])
    out[ends] = low >> WORD
    out = out.astype("<u4", copy=False).reshape(lanes, room)
    used = (ends + 1) - np.arange(lanes) * room
    table = zlib.compress(values.astype("<u4").tobytes() + freq.astype("<u4").tobytes())
    written = [MAGIC, struct.pack("<QIII", len(ids), lanes, len(values), len(table)), table]
    for lane in range(lanes):
        block = ids[lane * BLOCK : (lane + 1) * BLOCK]
        body = out[lane, : used[lane]].tobytes()
        written += [struct.pack("<III", len(block), len(body), zlib.crc32(block)), body]
    return b"".join(written)


def decode(data: bytes) -> np.ndarray:
    """The ids of a file; a block that does not match its checksum raises CorruptBlock."""
    if data[:4] != MAGIC:
        raise CorruptBlock("not a file of coded ids")
    total, lanes, distinct, size = struct.unpack_from("<QIII", data, 4)
    at = 4 + struct.calcsize("<QIII")
    if not lanes:
        return np.zeros(0, dtype=np.uint32)
    table = zlib.decompress(data[at : at + size])
    values = np.frombuffer(table[: 4 * distinct], dtype="<u4")
    freq = np.frombuffer(table[4 * distinct :], dtype="<u4")
    scale = ranges(freq)
    slot = np.repeat(np.arange(distinct, dtype=np.uint32), freq)
    at += size
    heads, bodies, after = [], [], np.zeros(1, dtype=np.uint32)
    for _ in range(lanes):
        head = struct.unpack_from("<III", data, at)
        at += 12
        heads.append(head)
        bodies += [np.frombuffer(data, dtype="<u4", count=head[1] // 4, offset=at), after]
        at += head[1]
    starts = np.cumsum([0, *map(len, bodies)])[:-1:2]
    body = np.concatenate(bodies).astype(np.uint64)
    code = body[starts] << WORD | body[starts + 1]
    ends = starts + 2
    model = Model(lanes)
    wide = np.full(lanes, (1 << 64) - 1, dtype=np.uint64)
    columns = np.zeros((min(total, BLOCK), lanes), dtype=np.uint32)
    for now in columns:
        guess, two, one = model.predict()
        unit = wide >> np.uint64(16)
        two *= unit
        one *= unit
        not_two, neither = code >= two, code >= one
        less, wide = split(wide, two, one, not_two, neither)
        code -= less
        np.subtract(guess[0], guess[1], out=now)
        now *= not_two
        now += guess[1]
        fresh = neither.nonzero()[0]
        unit = wide.take(fresh) >> np.uint64(SCALE_BITS)
        left = code.take(fresh)
        rank = slot.take((left // unit).view(np.int64), mode="clip")
        part = scale.take(rank)
        code[fresh] = left - (part >> WORD) * unit
        wide[fresh] = (part & (HIGH - np.uint64(1))) * unit
        now[fresh] = rank
        small = (wide < HIGH).nonzero()[0]
        if len(small):
            at = ends[small]
            code[small] = code[small] << WORD | body.take(at, mode="clip")
            ends[small] = at + 1
            wide[small] <<= WORD
        model.update(now, not_two, neither)
    del model
    ids = values.take(columns.T, mode="clip")
    for lane, (count, _, checksum) in enumerate(heads):
        if zlib.crc32(ids[lane, :count]) != checksum:
            raise CorruptBlock(f"block {lane} does not match its checksum")
    return ids.reshape(-1)[:total]
