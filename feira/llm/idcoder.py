"""Adaptive context-mixing range coder for token ids.

Ids are cut into blocks. Every block starts with a fresh model and a fresh coder and has its
own checksums, so with the segment's head each can be read alone. The blocks of a segment are
coded side by side: step t codes id t of every block, so that all work is on arrays with one
entry per block.

Predictions of an id: order 2 (what followed the last two ids), order 1 (what followed the
last id), order 0 (how often each id comes). The decision which of them is right gets its
frequencies from two adaptive tables, one for the block and one for how reliable the first two
have been, mixed with fixed weights. An id that neither of them has is coded by its order-0
frequency. Most different ids of a block come once or twice in it, so a block is too short to
learn these frequencies: they are counted over the segment, stand in its head, and every block
starts from them. Ids that come less than ``LISTED_FROM`` times are not listed there, but coded
by a sign of their own and their bits.

The coder keeps a range of 45 to 60 bits. The decision (up to 12 bits) and the frequency (up to
20) narrow it, then whole words of 16 bits leave; then, if need be, the bits of a rare id.

The segment's format, little-endian: ``FID2``; u32 blocks; u32 ids per block; u64 ids in all;
u32 listed ids; u8 bits of all frequencies together; u8 bits of a rare id; u32 bytes of the list;
u32 crc32 of the list; the list (zlib: gaps between ids and their frequencies, as u32); per block
u32 words, u32 crc32 of its words, u32 crc32 of its ids as u32; then the words, block after
block. The last block is filled up with its last id.
"""

import struct
import zlib

import numpy as np

BLOCK_IDS = 1024
MOST = 1 << 24
# An id is listed if it comes so often in a segment; at most so many are, the most frequent.
LISTED_FROM, MOST_LISTED = 3, 1 << 16
_MAGIC = b"FID2"
_HEAD = struct.Struct("<4sIIQIBBII")
_TOP, _LEAST = 60, 1 << 44
_TABLE_BITS = 8
# Steps after which the decision's frequencies are halved, and what an event adds to its own.
_HALVE, _STEP = 64, np.int64(4)
# Factors of the last id and of the one before it, where their guess stands.
_ONE, _TWO = np.uint16(40503), np.uint16(30011)
# One in each of the three fields of 20 bits; all bits of a field but its highest.
_EACH = 1 | 1 << 20 | 1 << 40
_HALVES = ((1 << 19) - 1) * _EACH
_FIELD = (1 << 20) - 1


class _Frequencies:
    """Order 0: how often each listed id comes, as shares of a power of two; number 0 is the sign
    for an id that is not listed."""

    def __init__(self, listed: np.ndarray, shares: np.ndarray, bits: int, rare_bits: int):
        self.ids = np.concatenate([[0], listed]).astype(np.int64)
        self.shares, self.bits, self.rare_bits = shares, bits, rare_bits
        self.starts = np.cumsum(shares) - shares

    @classmethod
    def of(cls, ids: np.ndarray) -> "_Frequencies":
        counts = np.bincount(ids)
        listed = np.flatnonzero(counts >= LISTED_FROM)
        if len(listed) > MOST_LISTED:
            order = np.argsort(-counts[listed], kind="stable")
            listed = np.sort(listed[order[:MOST_LISTED]])
        weights = np.concatenate([[0], counts[listed]]).astype(np.int64)
        weights[0] = len(ids) - weights.sum()
        bits = max(12, len(weights).bit_length() + 3)
        shares = 1 + weights * ((1 << bits) - len(weights)) // len(ids)
        shares[weights.argmax()] += (1 << bits) - shares.sum()
        return cls(listed, shares, bits, max(1, int(ids.max()).bit_length()))

    def with_all(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and shares, and at the end those of an id that needs none: all of the range."""
        return np.append(self.starts, 0), np.append(self.shares, 1 << self.bits)

    def numbers_by_id(self, highest: int) -> np.ndarray:
        numbers = np.zeros(highest + 1, np.int32)
        numbers[self.ids[1:]] = np.arange(1, len(self.ids))
        return numbers

    def numbers_by_point(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.shares), dtype=np.int32), self.shares)

    def packed(self) -> bytes:
        gaps = np.diff(self.ids[1:], prepend=0)
        return zlib.compress(gaps.astype("<u4").tobytes() + self.shares.astype("<u4").tobytes())

    @classmethod
    def unpacked(cls, data: bytes, listed: int, bits: int, rare_bits: int) -> "_Frequencies":
        numbers = np.frombuffer(zlib.decompress(data), "<u4").astype(np.int64)
        return cls(np.cumsum(numbers[:listed]), numbers[listed:], bits, rare_bits)


class _Model:
    """Predictions and frequencies of all blocks.

    Of arrays with two entries per block, the first half is for order 2, the second for order 1.
    A guess is kept with its trust (0 to 3) in its lowest two bits. The three frequencies of a
    decision share one number, 20 bits each, and are added and halved together. Where a guess
    stands follows from the lowest 16 bits of products, so these are numbers of 16 bits.
    """

    def __init__(self, lanes: int):
        self.lanes = lanes
        self.base = np.arange(2 * lanes) << _TABLE_BITS
        self.contexts = np.arange(lanes) << 4
        self.table = np.zeros(2 * lanes << _TABLE_BITS, np.int32)
        self.own = np.full(lanes, _EACH, np.int64)
        self.mixed = np.full(lanes << 4, 2 * _EACH, np.int64)
        self.last = np.zeros(lanes, np.uint16)
        self.before = np.zeros(lanes, np.uint16)
        self.steps = 0
        self.slots = np.empty(2 * lanes, np.uint16)
        self.places = np.empty(2 * lanes, np.int64)
        self.entries, self.new = (np.empty(2 * lanes, np.int32) for _ in range(2))
        self.context, self.now_mixed, self.each = (np.empty(lanes, np.int64) for _ in range(3))

    def predict(self) -> None:
        """Set the guesses and the frequencies of: first is right, second is, neither."""
        lanes, slots = self.lanes, self.slots
        one = self.last * _ONE
        np.bitwise_xor(one, self.before * _TWO, out=slots[:lanes])
        slots[:lanes] >>= 6
        np.right_shift(one, 7, out=slots[lanes:])
        slots &= (1 << _TABLE_BITS) - 1
        np.add(self.base, slots, out=self.places)
        self.table.take(self.places, out=self.entries, mode="clip")
        self.guesses = self.entries >> 2
        trusts = self.entries & 3
        np.add(self.contexts, trusts[:lanes] << 2 | trusts[lanes:], out=self.context)
        self.mixed.take(self.context, out=self.now_mixed, mode="clip")
        np.add(self.own, self.now_mixed, out=self.each)
        # times one in each field: every field holds the sum of itself and those before it
        self.sums = self.each * _EACH
        self.total = (self.sums >> 40) & _FIELD

    def span(self, shift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the frequencies of the decisions begin, and how large they are; ``shift`` is 20
        times the decision's number."""
        return ((self.sums << 20) >> shift) & _FIELD, (self.each >> shift) & _FIELD

    def learn(self, ids: np.ndarray, shift: np.ndarray, hits: np.ndarray) -> None:
        """``hits``: whether each of the two guesses was right."""
        event = _STEP << shift
        self.own += event
        event += event
        event += self.now_mixed
        self.mixed[self.context] = event
        new = ids << 2
        new |= 1
        self.new[: self.lanes] = new
        self.new[self.lanes :] = new
        # a right guess is trusted more, up to 3
        np.copyto(self.new, np.minimum(self.entries + 1, self.entries | 3), where=hits)
        self.table[self.places] = self.new
        self.before, self.last = self.last, ids.astype(np.uint16)
        self.steps += 1
        if self.steps % _HALVE == 0:
            for table in (self.own, self.mixed):
                table -= (table >> 1) & _HALVES


class _Writer:
    """Words of all blocks, with the low end and the width of each block's range.

    Blocks get their words at about the same pace, so word k of all blocks stand side by side.
    """

    def __init__(self, lanes: int, steps: int):
        self.low = np.zeros(lanes, np.int64)
        self.range = np.full(lanes, 1 << _TOP, np.int64)
        # room for every word that may come, reached in practice by ids that repeat nothing
        self.room = 2 * steps + 64
        self.words = np.zeros(lanes * self.room, np.int32)
        self.place = np.arange(lanes)
        self.sent = 0  # words of any block, at most

    def renew(self) -> None:
        """Settle carries and let whole words leave."""
        over = (self.low >= 1 << _TOP).nonzero()[0]
        if len(over):  # the word before takes it; what ripples on is settled at the end
            self.words[self.place[over] - len(self.low)] += 1
            self.low[over] -= 1 << _TOP
        short = (self.range < _LEAST).nonzero()[0]
        if len(short):
            self.sent += 2  # no block sends more in one step
            if self.sent >= self.room - 8:
                self.sent = int(self.place.max()) // len(self.low) + 2
                if self.sent >= self.room - 8:
                    self.words = np.concatenate([self.words, np.zeros_like(self.words)])
                    self.room *= 2
        while len(short):
            place, low, width = self.place.take(short), self.low.take(short), self.range.take(short)
            self.words[place] = low >> (_TOP - 16)
            self.place[short] = place + len(self.low)
            self.low[short] = (low & (_LEAST - 1)) << 16
            width <<= 16
            self.range[short] = width
            short = short[width < _LEAST]

    def finish(self) -> list[bytes]:
        # the top 32 bits of a number inside the range settle it; the reader adds zeros
        over = np.flatnonzero((self.low + (self.range >> 1)) >> _TOP)
        middle = self.low + (self.range >> 1)
        lanes = len(self.low)
        self.words[self.place[over] - lanes] += 1
        middle[over] -= 1 << _TOP
        for shift in (_TOP - 16, _TOP - 32):
            self.words[self.place] = (middle >> shift) & 0xFFFF
            self.place += lanes
        counts = self.place // lanes
        table = self.words[: int(counts.max()) * lanes]
        over = (table > 0xFFFF).nonzero()[0]
        while len(over):  # words that took a carry hand on what they cannot hold
            words = table.take(over)
            table[over] = words & 0xFFFF
            over = over - lanes
            table[over] += words >> 16
            over = over[table.take(over) > 0xFFFF]
        rows = np.ascontiguousarray(table.reshape(-1, lanes).T, "<u2")
        return [row[:count].tobytes() for row, count in zip(rows, counts.tolist(), strict=True)]


def encode(ids: np.ndarray, block_ids: int = BLOCK_IDS) -> bytes:
    """A segment of ids from 0 to ``MOST`` - 1."""
    if not len(ids):
        return _HEAD.pack(_MAGIC, 0, 0, 0, 0, 0, 0, 0, 0)
    if int(ids.min()) < 0 or int(ids.max()) >= MOST:
        raise ValueError(f"ids have to be from 0 to {MOST - 1}")
    steps = min(block_ids, len(ids))
    lanes = -(-len(ids) // steps)
    blocks = np.full(lanes * steps, ids[-1], np.int32)
    blocks[: len(ids)] = ids
    blocks = blocks.reshape(lanes, steps)
    order0 = _Frequencies.of(ids)
    numbers = order0.numbers_by_id(int(ids.max()))
    starts, shares = order0.with_all()
    model, writer = _Model(lanes), _Writer(lanes, steps)
    for now in np.ascontiguousarray(blocks.T):
        model.predict()
        hits = model.guesses.reshape(2, lanes) == now
        past = ~hits[0]
        missed = past & ~hits[1]
        shift = 20 * (missed.view(np.int8) + past.view(np.int8)).astype(np.int64)
        start, size = model.span(shift)
        unit = writer.range // model.total
        start *= unit
        size *= unit
        # number of the id where it is needed, else the one that stands for all shares
        number = numbers.take(now)
        np.copyto(number, len(starts) - 1, where=~missed)
        unit = size >> order0.bits
        writer.low += start
        writer.low += unit * starts.take(number)
        np.multiply(unit, shares.take(number), out=writer.range)
        writer.renew()
        rare = (number == 0).nonzero()[0]
        if len(rare):
            unit = writer.range[rare] >> order0.rare_bits
            writer.low[rare] += unit * now[rare]
            writer.range[rare] = unit
            writer.renew()
        model.learn(now, shift, hits.ravel())
    words, listed = writer.finish(), order0.packed()
    head = _HEAD.pack(
        _MAGIC, lanes, steps, len(ids), len(order0.ids) - 1, order0.bits, order0.rare_bits, len(listed), zlib.crc32(listed)
    )
    heads = [
        struct.pack("<III", len(code) // 2, zlib.crc32(code), zlib.crc32(block.astype("<u4")))
        for code, block in zip(words, blocks, strict=True)
    ]
    return b"".join([head, listed, *heads, *words])


def decode(segment: bytes) -> np.ndarray:
    """The ids of a segment. Raises ValueError if a checksum is wrong."""
    magic, lanes, steps, total, listed, bits, rare_bits, list_size, list_crc = _HEAD.unpack_from(segment)
    if magic != _MAGIC:
        raise ValueError("not a segment of token ids")
    if not total:
        return np.zeros(0, np.int64)
    begin = _HEAD.size + list_size
    packed = segment[_HEAD.size : begin]
    if zlib.crc32(packed) != list_crc:
        raise ValueError("the list of a segment's ids is damaged")
    order0 = _Frequencies.unpacked(packed, listed, bits, rare_bits)
    numbers = order0.numbers_by_point()
    starts, shares = order0.with_all()
    ids_of = np.append(order0.ids, 0).astype(np.int32)
    heads = np.frombuffer(segment, "<u4", 3 * lanes, begin).reshape(lanes, 3).astype(np.int64)
    words = np.frombuffer(segment, "<u2", heads[:, 0].sum(), begin + 12 * lanes)
    ends = np.cumsum(heads[:, 0])
    for end, (count, crc, _) in zip(ends, heads, strict=True):
        if zlib.crc32(words[end - count : end]) != crc:
            raise ValueError("a block of token ids is damaged")
    # word k of all blocks side by side; zeros stand for what is not there
    table = np.zeros((lanes, int(heads[:, 0].max()) + 8), np.uint16)
    for row, end, count in zip(table, ends.tolist(), heads[:, 0].tolist(), strict=True):
        row[:count] = words[end - count : end]
    words, place = np.ascontiguousarray(table.T).ravel(), np.arange(lanes)

    def word(some: np.ndarray) -> np.ndarray:
        here = place.take(some)
        place[some] = here + lanes
        return words.take(here, mode="clip").astype(np.int64)

    # 60 bits: three words and 12 bits of the fourth, whose other four wait
    everyone, code = np.arange(lanes), np.zeros(lanes, np.int64)
    for _ in range(3):
        code = code << 16 | word(everyone)
    got = word(everyone)
    code, spare = code << 12 | got >> 4, got & 15
    width = np.full(lanes, 1 << _TOP, np.int64)

    def refill() -> None:
        short = (width < _LEAST).nonzero()[0]
        while len(short):
            # the four bits that waited, and the word, whose last four will wait
            got = spare.take(short) << 16 | word(short)
            code[short] = code.take(short) << 16 | got >> 4
            spare[short] = got & 15
            wider = width.take(short) << 16
            width[short] = wider
            short = short[wider < _LEAST]

    model, columns = _Model(lanes), np.empty((steps, lanes), np.int32)
    for now in columns:
        model.predict()
        unit = width // model.total
        past = code >= unit * (model.sums & _FIELD)
        missed = code >= unit * ((model.sums >> 20) & _FIELD)
        shift = 20 * (missed.view(np.int8) + past.view(np.int8)).astype(np.int64)
        start, size = model.span(shift)
        start *= unit
        code -= start
        unit *= size
        unit >>= bits
        number = numbers.take(code // unit, mode="clip")
        np.copyto(number, len(starts) - 1, where=~missed)
        code -= unit * starts.take(number)
        np.multiply(unit, shares.take(number), out=width)
        refill()
        ids_of.take(number, out=now, mode="clip")
        guesses = model.guesses.reshape(2, lanes)
        np.copyto(now, guesses[1], where=past & ~missed)
        np.copyto(now, guesses[0], where=~past)
        rare = (number == 0).nonzero()[0]
        if len(rare):
            unit = width[rare] >> rare_bits
            value = np.minimum(code[rare] // unit, (1 << rare_bits) - 1)
            code[rare] -= unit * value
            width[rare] = unit
            now[rare] = value
            refill()
        model.learn(now, shift, (guesses == now).ravel())
    blocks = np.ascontiguousarray(columns.T)
    for block, (_, _, crc) in zip(blocks, heads, strict=True):
        if zlib.crc32(block.astype("<u4")) != crc:
            raise ValueError("a block of token ids does not give its checksum")
    return blocks.reshape(-1)[:total].astype(np.int64)
