"""Lossless WebP: a decoder for all features of the format and a small encoder.

Pixels are ``uint32`` ARGB arrays of shape (height, width). ``decode`` reads any still lossless file. ``decode_many``
decodes many images in step, one symbol of each at a time, with numpy, with colour caches and back-references; images of more
than one prefix code group fall back to the general decoder, symbol by symbol. The encoder uses a predictor, a
colour cache and back-references where they make a file shorter.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

PREDICTOR, CROSS_COLOUR, SUBTRACT_GREEN, PALETTE = range(4)
# Fixed values of the format: order of the code-length codes; offsets of the 120 short distance codes, as (x, y).
LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
NEAR = (
    (0, 1), (1, 0), (1, 1), (-1, 1), (0, 2), (2, 0), (1, 2), (-1, 2), (2, 1), (-2, 1), (2, 2), (-2, 2), (0, 3), (3, 0), (1, 3), (-1, 3),
    (3, 1), (-3, 1), (2, 3), (-2, 3), (3, 2), (-3, 2), (0, 4), (4, 0), (1, 4), (-1, 4), (4, 1), (-4, 1), (3, 3), (-3, 3), (2, 4), (-2, 4),
    (4, 2), (-4, 2), (0, 5), (3, 4), (-3, 4), (4, 3), (-4, 3), (5, 0), (1, 5), (-1, 5), (5, 1), (-5, 1), (2, 5), (-2, 5), (5, 2), (-5, 2),
    (4, 4), (-4, 4), (3, 5), (-3, 5), (5, 3), (-5, 3), (0, 6), (6, 0), (1, 6), (-1, 6), (6, 1), (-6, 1), (2, 6), (-2, 6), (6, 2), (-6, 2),
    (4, 5), (-4, 5), (5, 4), (-5, 4), (3, 6), (-3, 6), (6, 3), (-6, 3), (0, 7), (7, 0), (1, 7), (-1, 7), (5, 5), (-5, 5), (7, 1), (-7, 1),
    (4, 6), (-4, 6), (6, 4), (-6, 4), (2, 7), (-2, 7), (7, 2), (-7, 2), (3, 7), (-3, 7), (7, 3), (-7, 3), (5, 6), (-5, 6), (6, 5), (-6, 5),
    (8, 0), (4, 7), (-4, 7), (7, 4), (-7, 4), (8, 1), (8, 2), (6, 6), (-6, 6), (8, 3), (5, 7), (-5, 7), (7, 5), (-7, 5), (8, 4), (6, 7),
    (-6, 7), (7, 6), (-7, 6), (8, 5), (7, 7), (-7, 7), (8, 6), (8, 7))
GREEN_SYMBOLS, LITERALS, DISTANCES = 280, 256, 40
CACHE_FACTOR = 0x1E35A7BD
#: Longest code that the encoder makes; the lookup tables of the stepwise decoder have 2 ** CODE_BITS entries.
CODE_BITS = 11


class Corrupt(ValueError):
    pass


# ---- reading bits and prefix codes


class Bits:
    """Least significant bit first."""

    def __init__(self, data: bytes, at: int = 0):
        self.data, self.at, self.end = data, at, 8 * len(data)

    def read(self, n: int) -> int:
        low = self.at >> 3
        word = int.from_bytes(self.data[low:low + 8], "little") >> (self.at & 7)
        self.at += n
        if self.at > self.end:
            raise Corrupt("the data end early")
        return word & ((1 << n) - 1)


    def between(self, start: int, end: int) -> int:
        word = int.from_bytes(self.data[start >> 3:(end >> 3) + 1], "little") >> (start & 7)
        return word & ((1 << (end - start)) - 1)

    def peek(self, n: int) -> int:
        return self.between(self.at, self.at + n)


@dataclass
class Code:
    """A prefix code as a lookup table over ``bits`` bits: ``table[next bits] = symbol << 4 | length``."""

    bits: int
    table: np.ndarray

    def read(self, source: Bits) -> int:
        low = source.at >> 3
        word = int.from_bytes(source.data[low:low + 4], "little") >> (source.at & 7)
        entry = int(self.table[word & ((1 << self.bits) - 1)])
        source.at += entry & 15
        if source.at > source.end:
            raise Corrupt("the data end early")
        return entry >> 4


#: The 15 bits of every number in reverse.
_MIRROR = sum(((np.arange(1 << 15) >> i) & 1) << (14 - i) for i in range(15))
#: Codes for code lengths that were read before, by their description.
_SEEN: dict[tuple[int, int], tuple[int, list[int]]] = {}


def _reversed_codes(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols with a code in canonical order, and their codes with the first bit lowest."""
    used = np.flatnonzero(lengths)
    order = used[np.argsort(lengths[used], kind="stable")]
    n = lengths[order].astype(np.int64)
    # Canonical codes, left-aligned at 15 bits, are running sums.
    start = np.concatenate([[0], np.cumsum(1 << (15 - n))[:-1]])
    return order, _MIRROR[start]


def make_code(lengths: np.ndarray) -> Code:
    lengths = np.asarray(lengths, np.int64)
    used = np.flatnonzero(lengths)
    if len(used) <= 1:
        return Code(0, np.array([(int(used[0]) << 4) if len(used) else 0], np.int32))
    if (1 << (15 - lengths[used])).sum() != 1 << 15:
        raise Corrupt("a prefix code is not complete")
    symbols = used[np.argsort(lengths[used], kind="stable")]
    n = lengths[symbols]
    bits = int(n[-1])
    # In canonical order the codes fill the table from the first bit on; the stream has the first bit lowest.
    table = np.repeat(symbols << 4 | n, 1 << (bits - n))
    return Code(bits, table[_MIRROR[:1 << bits] >> (15 - bits)].astype(np.int32))


def read_lengths(source: Bits, size: int) -> np.ndarray:
    lengths = np.zeros(size, np.int64)
    if source.read(1):
        two = source.read(1)
        lengths[source.read(8 if source.read(1) else 1)] = 1
        if two:
            lengths[source.read(8)] = 1
        return lengths
    given = 4 + source.read(4)
    described = source.read(3 * given)
    if (given, described) not in _SEEN:
        if len(_SEEN) > 1000:
            _SEEN.clear()
        first = np.zeros(19, np.int64)
        for i in range(given):
            first[LENGTH_ORDER[i]] = described >> 3 * i & 7
        code = make_code(first)
        _SEEN[given, described] = code.bits, code.table.tolist()
    bits, table = _SEEN[given, described]
    left = 2 + source.read(2 + 2 * source.read(3)) if source.read(1) else size
    out: list[int] = []
    last, mask, data, pos, have, word = 8, (1 << bits) - 1, source.data, source.at, 0, 0
    while len(out) < size and left:
        left -= 1
        if have < 14:  # the most that a step reads
            word, have = int.from_bytes(data[pos >> 3:(pos >> 3) + 8], "little") >> (pos & 7), 64 - (pos & 7)
        entry = table[word & mask]
        used = entry & 15
        symbol = entry >> 4
        if symbol < 16:
            out.append(symbol)
            last = symbol or last
        else:
            extra, base, value = ((2, 3, last), (3, 3, 0), (7, 11, 0))[symbol - 16]
            out += [value] * (base + (word >> used & ((1 << extra) - 1)))
            used += extra
        pos += used
        word >>= used
        have -= used
    source.at = pos
    if pos > source.end or len(out) > size:
        raise Corrupt("the data end early, or there are too many code lengths")
    lengths[:len(out)] = out
    return lengths


def _prefix_value(symbol: int, source: Bits) -> int:
    if symbol < 4:
        return symbol + 1
    extra = (symbol - 2) >> 1
    return ((2 + (symbol & 1)) << extra) + source.read(extra) + 1


# ---- images


def _read_group(source: Bits, cache: int) -> list[Code]:
    return [make_code(read_lengths(source, n)) for n in (GREEN_SYMBOLS + cache, LITERALS, LITERALS, LITERALS, DISTANCES)]


def read_image(source: Bits, width: int, height: int, main: bool) -> np.ndarray:
    """An entropy-coded image: literals, back-references and colour-cache entries."""
    cache_bits = source.read(4) if source.read(1) else 0
    if cache_bits > 11:
        raise Corrupt("the colour cache is too large")
    groups_at, shift, across = None, 0, 1
    if main and source.read(1):
        shift = source.read(3) + 2
        across = -(-width >> shift)
        groups_at = ((read_image(source, across, -(-height >> shift), False) >> 8) & 0xFFFF).ravel()
    size = 1 << cache_bits if cache_bits else 0
    groups = [_read_group(source, size) for _ in range(int(groups_at.max()) + 1 if groups_at is not None else 1)]
    out = [0] * (width * height)
    cache = [0] * size

    def remember(pixel: int) -> None:
        if size:
            cache[((CACHE_FACTOR * pixel) & 0xFFFFFFFF) >> (32 - cache_bits)] = pixel

    at = 0
    while at < len(out):
        group = groups[int(groups_at[(at // width >> shift) * across + (at % width >> shift)])] if groups_at is not None else groups[0]
        symbol = group[0].read(source)
        if symbol < LITERALS:
            red, blue, alpha = group[1].read(source), group[2].read(source), group[3].read(source)
            out[at] = alpha << 24 | red << 16 | symbol << 8 | blue
            remember(out[at])
            at += 1
        elif symbol < GREEN_SYMBOLS:
            n = _prefix_value(symbol - LITERALS, source)
            code = _prefix_value(group[4].read(source), source)
            if code > len(NEAR):
                back = code - len(NEAR)
            else:
                x, y = NEAR[code - 1]
                back = max(1, x + y * width)
            if back > at or at + n > len(out):
                raise Corrupt("a reference leaves the image")
            for _ in range(n):
                out[at] = out[at - back]
                remember(out[at])
                at += 1
        else:
            out[at] = cache[symbol - GREEN_SYMBOLS]
            remember(out[at])
            at += 1
    return np.array(out, np.uint32).reshape(height, width)


def _average(a: int, b: int) -> int:
    return (((a ^ b) & 0xFEFEFEFE) >> 1) + (a & b)


def _channels(p: int) -> tuple[int, int, int, int]:
    return p >> 24, p >> 16 & 255, p >> 8 & 255, p & 255


def _pack(values) -> int:
    out = 0
    for v in values:
        out = out << 8 | min(255, max(0, v))
    return out


def _select(left: int, top: int, corner: int) -> int:
    a, b, c = _channels(left), _channels(top), _channels(corner)
    # Distance of the gradient a + b - c to either side.
    return left if sum(abs(y - z) for y, z in zip(b, c)) < sum(abs(x - z) for x, z in zip(a, c)) else top


def _full(a: int, b: int, c: int) -> int:
    return _pack(x + y - z for x, y, z in zip(_channels(a), _channels(b), _channels(c)))


def _half(a: int, b: int) -> int:
    return _pack(x + int((x - y) / 2) for x, y in zip(_channels(a), _channels(b)))


def predicted(mode: int, left: int, top: int, right: int, corner: int) -> int:
    """Prediction of a pixel from its neighbours; ``right`` is top right, ``corner`` top left."""
    if mode == 0 or mode > 13:
        return 0xFF000000
    if mode <= 4:
        return (left, top, right, corner)[mode - 1]
    if mode <= 10:
        a, b = {
            5: (_average(left, right), top), 6: (left, corner), 7: (left, top), 8: (corner, top), 9: (top, right),
            10: (_average(left, corner), _average(top, right))}[mode]
        return _average(a, b)
    if mode == 11:
        return _select(left, top, corner)
    return _full(left, top, corner) if mode == 12 else _half(_average(left, top), corner)


def _add(a: int, b: int) -> int:
    return ((a & 0xFF00FF00) + (b & 0xFF00FF00)) & 0xFF00FF00 | ((a & 0x00FF00FF) + (b & 0x00FF00FF)) & 0x00FF00FF


def _running(residuals: np.ndarray, mode: int) -> np.ndarray:
    """``undo_predictor`` for a single mode, left (1) or top (2): the neighbours' sums, channel by channel."""
    parts = np.ascontiguousarray(residuals, np.uint32).view(np.uint8).reshape(*residuals.shape, 4).copy()
    parts[0, 0] += np.array([0, 0, 0, 255], np.uint8)
    if mode == 1:
        parts[:, 0] = np.cumsum(parts[:, 0], axis=0, dtype=np.uint8)
        parts = np.cumsum(parts, axis=1, dtype=np.uint8)
    else:
        parts[0] = np.cumsum(parts[0], axis=0, dtype=np.uint8)
        parts = np.cumsum(parts, axis=0, dtype=np.uint8)
    return np.ascontiguousarray(parts).view(np.uint32).reshape(residuals.shape)


def undo_predictor(image: np.ndarray, modes: np.ndarray, bits: int) -> np.ndarray:
    height, width = image.shape
    used = np.unique(modes >> 8 & 15)
    if len(used) == 1 and used[0] in (1, 2):
        return _running(image, int(used[0]))
    rows: list[list[int]] = []
    for y, line in enumerate(image.tolist()):
        above, now = rows[-1] if rows else [], []
        for x, residual in enumerate(line):
            if y == 0:
                guess = now[-1] if x else 0xFF000000
            elif x == 0:
                guess = above[0]
            else:
                mode = int(modes[y >> bits, x >> bits]) >> 8 & 15
                guess = predicted(mode, now[-1], above[x], above[x + 1] if x + 1 < width else now[0], above[x - 1])
            now.append(_add(residual, guess))
        rows.append(now)
    return np.array(rows, np.uint32)


def _signed(x: np.ndarray) -> np.ndarray:
    return (x.astype(np.int64) & 255 ^ 128) - 128


def cross_colour(image: np.ndarray, factors: np.ndarray, bits: int, inverse: bool = True) -> np.ndarray:
    height, width = image.shape
    f = np.repeat(np.repeat(factors, 1 << bits, 0), 1 << bits, 1)[:height, :width]
    red, green, blue = image >> 16 & 255, image >> 8 & 255, image & 255
    delta = lambda a, b: _signed(a) * _signed(b) >> 5
    sign = 1 if inverse else -1
    new_red = (red.astype(np.int64) + sign * delta(f, green)) & 255
    new_blue = (blue.astype(np.int64) + sign * (delta(f >> 8, green) + delta(f >> 16, new_red if inverse else red))) & 255
    return (image & 0xFF00FF00) | (new_red << 16).astype(np.uint32) | new_blue.astype(np.uint32)


def add_green(image: np.ndarray, sign: int = 1) -> np.ndarray:
    green = (image >> 8 & 255).astype(np.int64)
    red, blue = ((image >> 16 & 255) + sign * green) & 255, ((image & 255) + sign * green) & 255
    return (image & 0xFF00FF00) | (red << 16).astype(np.uint32) | blue.astype(np.uint32)


def _palette_bits(n: int) -> int:
    return 3 if n <= 2 else 2 if n <= 4 else 1 if n <= 16 else 0


def undo_palette(image: np.ndarray, colours: np.ndarray, width: int) -> np.ndarray:
    bits = _palette_bits(len(colours))
    index = image >> 8 & 255
    if bits:
        depth = 8 >> bits
        index = (index[:, :, None] >> (np.arange(1 << bits) * depth)) & ((1 << depth) - 1)
        index = index.reshape(image.shape[0], -1)[:, :width]
    table = np.zeros(256, np.uint32)
    table[:len(colours)] = colours
    return table[index]


def _transforms(source: Bits, width: int, height: int) -> tuple[list[tuple], int]:
    found, at = [], width
    while source.read(1):
        kind = source.read(2)
        if any(t[0] == kind for t in found):
            raise Corrupt("a transform comes twice")
        if kind in (PREDICTOR, CROSS_COLOUR):
            bits = source.read(3) + 2
            found.append((kind, read_image(source, -(-at >> bits), -(-height >> bits), False), bits))
        elif kind == PALETTE:
            steps = read_image(source, source.read(8) + 1, 1, False)[0]
            channels = np.cumsum(steps.view(np.uint8).reshape(-1, 4), axis=0, dtype=np.uint64).astype(np.uint8)
            colours = np.ascontiguousarray(channels).view(np.uint32).ravel()
            found.append((kind, colours, at))
            at = -(-at >> _palette_bits(len(colours)))
        else:
            found.append((kind,))
    return found, at


def _undo(image: np.ndarray, transforms: list[tuple]) -> np.ndarray:
    for t in reversed(transforms):
        if t[0] == PREDICTOR:
            image = undo_predictor(image, t[1], t[2])
        elif t[0] == CROSS_COLOUR:
            image = cross_colour(image, t[1], t[2])
        elif t[0] == SUBTRACT_GREEN:
            image = add_green(image)
        else:
            image = undo_palette(image, t[1], t[2])
    return image


def _open(data: bytes) -> tuple[Bits, int, int]:
    if len(data) < 26 or data[:4] != b"RIFF" or data[8:16] != b"WEBPVP8L":
        raise Corrupt("not a lossless WebP file")
    n = struct.unpack_from("<I", data, 16)[0]
    source = Bits(data[20:20 + n])
    if source.read(8) != 0x2F:
        raise Corrupt("the signature is missing")
    width, height = source.read(14) + 1, source.read(14) + 1
    source.read(1)
    if source.read(3):
        raise Corrupt("unknown version")
    return source, width, height


def decode(data: bytes) -> np.ndarray:
    source, width, height = _open(data)
    transforms, inner = _transforms(source, width, height)
    return _undo(read_image(source, inner, height, True), transforms)


def decode_many(files: list[bytes]) -> list[np.ndarray]:
    """``decode`` of many files, in step where they have one group of codes."""
    out: list[np.ndarray | None] = [None] * len(files)
    images, rich, tables, known = [], [], [np.zeros(1, np.int32)], {}
    offset = 1
    for i, data in enumerate(files):
        source, width, height = _open(data)
        transforms, inner = _transforms(source, width, height)
        start = source.at
        cache_bits = source.read(4) if source.read(1) else 0
        if cache_bits > 11 or source.read(1):
            source.at = start
            out[i] = _undo(read_image(source, inner, height, True), transforms)
            continue
        places, last, plain = [], None, True
        for k, n in enumerate((GREEN_SYMBOLS + ((1 << cache_bits) if cache_bits else 0), LITERALS, LITERALS, LITERALS, DISTANCES)):
            if last is not None and k < 4 and source.peek(last[1]) == last[0]:
                source.at += last[1]  # the description of the code before, again
                places.append(places[-1])
                continue
            begin = source.at
            lengths = read_lengths(source, n)
            if k in (1, 2, 3):
                last = source.between(begin, source.at), source.at - begin
            elif k == 0:
                plain = not lengths[LITERALS:].any()
            elif plain:
                continue  # no distance is ever read
            key = lengths[:LITERALS].tobytes() if not lengths[LITERALS:].any() else lengths.tobytes()
            if key not in known:
                code = make_code(lengths)
                known[key] = offset, (1 << code.bits) - 1
                tables.append(code.table)
                offset += len(code.table)
            places.append(known[key])
        (images if plain else rich).append((i, source, inner, height, transforms, places, start, cache_bits))
    if rich:
        _decode_rich(rich, np.concatenate(tables), out)
    if not images:
        return out
    images.sort(key=lambda x: -(x[2] * x[3]))
    table = np.concatenate(tables)
    data = [x[1].data for x in images]
    starts = np.cumsum([0, *map(len, data)])
    raw = np.frombuffer(b"".join(data) + bytes(8), np.uint8).astype(np.uint32)
    words = raw[:-3] | raw[1:-2] << 8 | raw[2:-1] << 16 | raw[3:] << 24
    at = starts[:-1] * 8 + np.array([x[1].at for x in images])
    end = starts[1:] * 8
    base = np.array([[p[0] for p in x[5]] for x in images]).T
    mask = np.array([[p[1] for p in x[5]] for x in images], np.uint32).T
    sizes = np.array([x[2] * x[3] for x in images])
    place = np.cumsum([0, *sizes[:-1]])
    pixels = np.zeros(int(sizes.sum()), np.uint32)
    plain = np.ones(len(images), bool)
    live = np.searchsorted(-sizes, -np.arange(int(sizes[0])), "left")  # images with more than k pixels
    for k in range(int(sizes[0])):
        n = int(live[k])
        pos, value = at[:n], None
        for channel, shift in ((0, 8), (1, 16), (2, 0), (3, 24)):
            word = words[np.minimum(pos >> 3, len(words) - 1)] >> (pos & 7).astype(np.uint32)
            entry = table[base[channel, :n] + (word & mask[channel, :n])]
            pos = pos + (entry & 15)
            symbol = entry >> 4
            if channel == 0:
                plain[:n] &= symbol < LITERALS
            symbol = (symbol & 255).astype(np.uint32) << np.uint32(shift)
            value = symbol if value is None else value | symbol
        at[:n] = pos
        pixels[place[:n] + k] = value
    good = plain & (at <= end)
    _place(images, pixels, place, good, out)
    return out


def _place(images: list[tuple], pixels: np.ndarray, place: np.ndarray, good: np.ndarray, out: list) -> None:
    """Undo the transforms. What did not decode in step goes through the general decoder, which names the fault."""
    for (i, source, inner, height, transforms, _, start, _), ok, p in zip(images, good, place):
        if ok:
            image = pixels[p:p + inner * height].reshape(height, inner)
        else:
            source.at = start
            image = read_image(source, inner, height, True)
        out[i] = _undo(image, transforms)


_NEAR = np.array([(0, 0), *NEAR], np.int64)


def _decode_rich(images: list[tuple], table: np.ndarray, out: list) -> None:
    """Images with colour caches or back-references, in step: one literal, cache entry or reference of each at a time."""
    data = [x[1].data for x in images]
    starts = np.cumsum([0, *map(len, data)])
    raw = np.frombuffer(b"".join(data) + bytes(8), np.uint8).astype(np.uint32)
    words = raw[:-3] | raw[1:-2] << 8 | raw[2:-1] << 16 | raw[3:] << 24
    at, end = starts[:-1] * 8 + np.array([x[1].at for x in images]), starts[1:] * 8
    base = np.array([[p[0] for p in x[5]] for x in images]).T
    mask = np.array([[p[1] for p in x[5]] for x in images], np.uint32).T
    width, sizes = np.array([x[2] for x in images]), np.array([x[2] * x[3] for x in images])
    place = np.cumsum([0, *sizes[:-1]])
    bits = np.array([x[7] for x in images])
    slots = np.cumsum([0, *np.where(bits, 1 << bits, 0)[:-1]])
    cache = np.zeros(int(slots[-1]) + (1 << 11), np.uint32)
    pixels, done = np.zeros(int(sizes.sum()), np.uint32), np.zeros(len(images), np.int64)
    good = np.ones(len(images), bool)

    def word(own: np.ndarray) -> np.ndarray:
        pos = at[own]
        return words[np.minimum(pos >> 3, len(words) - 1)] >> (pos & 7).astype(np.uint32)

    def symbols(code: int, own: np.ndarray) -> np.ndarray:
        entry = table[base[code, own] + (word(own) & mask[code, own])]
        at[own] += entry & 15
        return entry >> 4

    def values(symbol: np.ndarray, own: np.ndarray) -> np.ndarray:
        extra = np.where(symbol < 4, 0, (symbol - 2) >> 1).astype(np.int64)
        more = word(own).astype(np.int64) & ((1 << extra) - 1)
        at[own] += extra
        return np.where(symbol < 4, symbol + 1, ((2 + (symbol & 1)) << extra) + more + 1)

    def remember(own: np.ndarray, value: np.ndarray) -> None:
        have = bits[own] > 0
        own, value = own[have], value[have]
        slot = (value * np.uint32(CACHE_FACTOR)) >> (32 - bits[own]).astype(np.uint32)
        cache[slots[own] + slot] = value  # of several values for a slot the last one stays

    live = np.arange(len(images))
    while len(live):
        symbol = symbols(0, live)
        own = live[symbol < LITERALS]
        if len(own):
            value = symbol[symbol < LITERALS].astype(np.uint32) << np.uint32(8)
            for code, shift in ((1, 16), (2, 0), (3, 24)):
                value |= symbols(code, own).astype(np.uint32) << np.uint32(shift)
            pixels[place[own] + done[own]] = value
            remember(own, value)
            done[own] += 1
        cached = symbol >= GREEN_SYMBOLS
        if cached.any():
            own = live[cached]
            value = cache[slots[own] + symbol[cached] - GREEN_SYMBOLS]
            pixels[place[own] + done[own]] = value
            remember(own, value)
            done[own] += 1
        refers = (symbol >= LITERALS) & ~cached
        if refers.any():
            own = live[refers]
            n = values(symbol[refers] - LITERALS, own)
            code = values(symbols(4, own), own)
            near = _NEAR[np.where(code > len(NEAR), 0, code)]
            back = np.where(code > len(NEAR), code - len(NEAR), np.maximum(1, near[:, 0] + near[:, 1] * width[own]))
            fits = (back <= done[own]) & (done[own] + n <= sizes[own])
            good[own[~fits]] = False
            own, n, back = own[fits], n[fits], back[fits]
            step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            first, period = np.repeat(place[own] + done[own], n), np.repeat(back, n)
            # A reference that reaches into itself repeats its first ``back`` pixels.
            value = pixels[first - period + step % period]
            pixels[first + step] = value
            remember(np.repeat(own, n), value)
            done[own] += n
        live = live[good[live] & (done[live] < sizes[live])]
    _place(images, pixels, place, good & (at <= end), out)


# ---- writing


def code_lengths(counts: np.ndarray, limit: int = CODE_BITS) -> np.ndarray:
    """Lengths of a complete prefix code; counts are flattened until no code is longer than ``limit``."""
    used = np.flatnonzero(counts).tolist()
    lengths = np.zeros(len(counts), np.int64)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    weight, m = np.asarray(counts, np.int64)[used], len(used)
    while True:
        order = np.argsort(weight, kind="stable")
        # Leaves in order of weight; joint nodes arise in order of weight, too.
        nodes, parent, leaf, joint = weight[order].tolist() + [0] * (m - 1), [0] * (2 * m - 1), 0, m
        for k in range(m, 2 * m - 1):
            for _ in range(2):
                if joint >= k or leaf < m and nodes[leaf] <= nodes[joint]:
                    parent[leaf] = k
                    nodes[k] += nodes[leaf]
                    leaf += 1
                else:
                    parent[joint] = k
                    nodes[k] += nodes[joint]
                    joint += 1
        depth = [0] * (2 * m - 1)
        for i in range(2 * m - 3, -1, -1):
            depth[i] = depth[parent[i]] + 1
        if max(depth[:m]) <= limit:
            lengths[np.asarray(used)[order]] = depth[:m]
            return lengths
        weight = np.maximum(1, weight >> 2) + 1 if weight.max() > 2 else np.ones(m, np.int64)


class Writer:
    def __init__(self):
        self.value, self.size = 0, 0

    def put(self, value: int, n: int) -> None:
        self.value |= value << self.size
        self.size += n

    def append(self, other: "Writer") -> None:
        self.put(other.value, other.size)

    def data(self) -> bytes:
        return self.value.to_bytes((self.size + 7) // 8, "little")


#: A fixed complete code for code lengths: 0 to 15 in 4 or 5 bits, zero runs in 3.
_FIRST = np.array([4, 5, 5, 4, 4, 4, 4, 4, 4, 4, 4, 5, 5, 5, 5, 5, 5, 4, 3])


def _first_codes() -> dict[int, tuple[int, int]]:
    lengths = _FIRST.copy()
    symbols, codes = _reversed_codes(lengths)
    return {int(s): (int(c), int(lengths[s])) for s, c in zip(symbols, codes)}


def write_lengths(lengths: np.ndarray) -> Writer:
    """The description of a prefix code."""
    out = Writer()
    used = np.flatnonzero(lengths)
    if len(used) <= 1 and (not len(used) or used[0] < 256):
        out.put(1, 1)
        out.put(0, 1)
        out.put(1, 1)
        out.put(int(used[0]) if len(used) else 0, 8)
        return out
    if not _FIXED:
        _FIXED.update(_first_codes())
    out.put(0, 1)
    out.put(19 - 4, 4)
    for s in LENGTH_ORDER:
        out.put(int(_FIRST[s]), 3)
    out.put(0, 1)
    value, size, at = 0, 0, 0

    def put(code: int, n: int) -> None:
        nonlocal value, size
        value |= code << size
        size += n

    for place, n in zip([*used.tolist(), len(lengths)], [*lengths[used].tolist(), None]):
        zeros = place - at
        while zeros:
            run = min(zeros, 138)
            if run >= 11:
                put(*_FIXED[18])
                put(run - 11, 7)
            elif run >= 3:
                put(*_FIXED[17])
                put(run - 3, 3)
            else:
                run = 1
                put(*_FIXED[0])
            zeros -= run
        if n is not None:
            put(*_FIXED[n])
        at = place + 1
    out.put(value, size)
    return out


_FIXED: dict[int, tuple[int, int]] = {}


def _riff(payload: bytes) -> bytes:
    body = b"WEBPVP8L" + struct.pack("<I", len(payload)) + payload + b"\0" * (len(payload) & 1)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def _packed_bits(codes: np.ndarray, lengths: np.ndarray) -> tuple[int, int]:
    """Codes of given lengths, one after another, as one number."""
    ends = np.cumsum(lengths)
    start = ends - lengths
    total = int(ends[-1]) if len(ends) else 0
    words = np.zeros(total // 32 + 2, np.uint64)
    at, shift = start >> 5, (start & 31).astype(np.uint64)
    spread = codes.astype(np.uint64) << shift
    # Codes do not overlap, so sums of the parts in a word are their union.
    low = np.bincount(at, (spread & np.uint64(0xFFFFFFFF)).astype(np.float64), len(words)).astype(np.uint64)
    high = np.bincount(at + 1, (spread >> np.uint64(32)).astype(np.float64), len(words)).astype(np.uint64)
    return int.from_bytes((low + high).astype("<u4").tobytes(), "little"), total


#: Pixels that a back-reference repeats at least; it costs about as many bits as two literals.
SHORTEST = 2
#: Share of its bits that an image must save, by estimate, to be tried with back-references and a cache.
LEAST_GAIN = 0.07


def _value_parts(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of lengths or distances from 1, the number of their extra bits, and these bits."""
    d = np.asarray(values, np.int64) - 1
    high = np.log2(np.maximum(d, 1)).astype(np.int64)
    extra = np.where(d < 4, 0, high - 1)
    return np.where(d < 4, d, 2 * high + (d >> np.maximum(high - 1, 0) & 1)), extra, d & ((1 << extra) - 1)


@lru_cache(maxsize=8)
def _near_codes(width: int) -> dict[int, int]:
    """The first short code of each distance that has one."""
    return {max(1, x + y * width): i for i, (x, y) in reversed(list(enumerate(NEAR, 1)))}


def _references(p: np.ndarray) -> list[tuple[int, int, int]]:
    """``(place, length, distance)`` of repeats from left to right: each to the nearest earlier place that begins alike."""
    key = p[:-1].astype(np.uint64) << np.uint64(32) | p[1:]
    order = np.argsort(key, kind="stable")
    same = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    earlier = np.full(len(key), -1, np.int64)
    earlier[order[same + 1]] = order[same]
    found, until = [], 0
    for i in np.flatnonzero(earlier >= 0).tolist():
        if i < until:
            continue
        j = int(earlier[i])
        differ = p[i:] != p[j:j + len(p) - i]
        n = int(differ.argmax()) if differ.any() else len(p) - i
        n = min(n, 4096)
        if n >= SHORTEST:
            found.append((i, n, i - j))
            until = i + n
    return found


def _cache_slots(p: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Slot of each pixel, and whether the cache holds it there: the last pixel of the slot was the same one."""
    slot = ((p * np.uint32(CACHE_FACTOR)) >> np.uint32(32 - bits)).astype(np.int64)
    order = np.argsort(slot, kind="stable")
    held = np.zeros(len(p), bool)
    held[order[1:]] = (slot[order[1:]] == slot[order[:-1]]) & (p[order[1:]] == p[order[:-1]])
    return slot, held


def _coded(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code and number of bits of each symbol; a lone symbol takes none."""
    code = np.zeros(len(lengths), np.int64)
    symbols, values = _reversed_codes(lengths)
    code[symbols] = values
    return code, lengths if len(symbols) > 1 else np.zeros(len(lengths), np.int64)


def _bits_of(lengths: np.ndarray, counts: np.ndarray) -> int:
    return int((lengths * counts).sum()) if np.count_nonzero(lengths) > 1 else 0


def _rich_image(p: np.ndarray, width: int, most: int) -> Writer | None:
    """The image with back-references and a colour cache; None if that can not be shorter than ``most`` bits."""
    if len(p) <= SHORTEST:
        return None
    found = _references(p)
    cache_bits = max(1, min(8, len(p).bit_length() - 3))
    slot, held = _cache_slots(p, cache_bits)
    inside = np.zeros(len(p), bool)
    for i, n, _ in found:
        inside[i:i + n] = True
    hits = int((held & ~inside).sum())
    # What a literal (a pixel's share of ``most``), a reference and a cache entry cost, roughly.
    literal = most / len(p)
    cached = hits * (literal - 12) > 60
    gain = literal * int(inside.sum()) - 27 * len(found) + (hits * (literal - 12) if cached else 0)
    if gain < 100 + LEAST_GAIN * most:
        return None
    starts = np.zeros(len(p), bool)
    starts[[i for i, _, _ in found]] = True
    at = np.flatnonzero(~inside | starts)
    refers, entry = starts[at], ~inside[at] & held[at] if cached else np.zeros(len(at), bool)
    literal_at = ~refers & ~entry
    q = p[at]
    symbol = (q >> 8 & 255).astype(np.int64)
    symbol[entry] = GREEN_SYMBOLS + slot[at[entry]]
    near = _near_codes(width)
    length, length_bits, length_more = _value_parts(np.array([n for _, n, _ in found], np.int64))
    back, back_bits, back_more = _value_parts(np.array([near.get(d, d + len(NEAR)) for _, _, d in found], np.int64))
    symbol[refers] = LITERALS + length
    other = np.stack([q >> 16 & 255, q & 255, q >> 24], 1).astype(np.int64)
    counts = [np.bincount(symbol, minlength=GREEN_SYMBOLS + ((1 << cache_bits) if cached else 0)),
              np.bincount(other[literal_at].ravel(), minlength=LITERALS), np.bincount(back, minlength=DISTANCES)]
    lengths = [code_lengths(c) for c in counts]
    out = Writer()
    out.put(int(cached), 1)
    if cached:
        out.put(cache_bits, 4)
    out.put(0, 1)
    described = [write_lengths(x) for x in lengths]
    for i in (0, 1, 1, 1, 2):
        out.append(described[i])
    if out.size + sum(_bits_of(x, c) for x, c in zip(lengths, counts)) + int(length_bits.sum() + back_bits.sum()) >= most:
        return None
    (green, green_n), (rest, rest_n), (far, far_n) = map(_coded, lengths)
    codes, sizes = np.zeros((len(at), 4), np.int64), np.zeros((len(at), 4), np.int64)
    codes[:, 0], sizes[:, 0] = green[symbol], green_n[symbol]
    codes[literal_at, 1:], sizes[literal_at, 1:] = rest[other[literal_at]], rest_n[other[literal_at]]
    codes[refers, 1:] = np.stack([length_more, far[back], back_more], 1)
    sizes[refers, 1:] = np.stack([length_bits, far_n[back], back_bits], 1)
    out.put(*_packed_bits(codes.ravel(), sizes.ravel()))
    return out


def _residuals(image: np.ndarray, mode: int) -> np.ndarray:
    """What the predictor left (1) or top (2) leaves of each pixel."""
    parts = np.ascontiguousarray(image, np.uint32).view(np.uint8).reshape(*image.shape, 4)
    guess = np.zeros_like(parts)
    guess[0, 1:], guess[1:, 0], guess[0, 0, 3] = parts[0, :-1], parts[:-1, 0], 255
    guess[1:, 1:] = parts[1:, :-1] if mode == 1 else parts[:-1, 1:]
    return np.ascontiguousarray(parts - guess).view(np.uint32).reshape(image.shape)


def _information(samples: np.ndarray) -> float:
    """Bits that the samples take by their own frequencies."""
    n = np.bincount(samples, minlength=256)
    n = n[n > 0]
    return float(len(samples) * np.log2(len(samples)) - (n * np.log2(n)).sum())


def encode_samples(samples: np.ndarray, width: int = 16) -> bytes:
    """Bytes as a lossless file: four bytes a pixel, rows of ``width`` pixels.

    Residuals of a predictor are stored where they hold clearly less information than the samples. Then
    the shorter of two forms: one prefix code for all channels, or back-references with or without a colour cache.
    """
    image = samples.view(">u4").astype(np.uint32).reshape(-1, width)
    out = Writer()
    out.put(0x2F, 8)
    out.put(width - 1, 14)
    out.put(len(image) - 1, 14)
    out.put(1, 1)
    out.put(0, 3)
    plain, mode = _information(samples) - 200, 0
    for m in (1, 2):
        left = _residuals(image, m)
        if (own := _information(left.reshape(-1).view(np.uint8))) < plain:
            plain, mode = own, m
    if mode:
        image = _residuals(image, mode)
        samples = np.frombuffer(image.astype(">u4").tobytes(), np.uint8)
        out.put(1, 1)
        out.put(PREDICTOR, 2)
        out.put(7, 3)  # blocks of 512 x 512 pixels, all of one mode, which takes no bits
        out.put(0, 1)
        for symbol in (mode, 0, 0, 0, 0):
            own = np.zeros(LITERALS, np.int64)
            own[symbol] = 1
            out.append(write_lengths(own))
    out.put(0, 1)
    counts = np.bincount(samples, minlength=256)
    lengths = code_lengths(counts)
    literal = write_lengths(lengths)
    # The description of green's code is a few bits longer, for the symbols of references.
    rich = _rich_image(image.ravel(), width, 4 * literal.size + 20 + _bits_of(lengths, counts))
    if rich is None:
        rich = Writer()
        rich.put(0, 1 + 1)  # no cache, one group
        rich.append(write_lengths(np.concatenate([lengths, np.zeros(GREEN_SYMBOLS - 256, np.int64)])))
        for _ in range(3):
            rich.append(literal)
        rich.append(write_lengths(np.zeros(DISTANCES, np.int64)))
        code, used = _coded(lengths)
        # Bytes of a pixel are alpha, red, green, blue; the stream has green, red, blue, alpha.
        stream = samples.reshape(-1, 4)[:, (2, 1, 3, 0)].ravel()
        rich.put(*_packed_bits(code[stream], used[stream]))
    out.append(rich)
    return _riff(out.data())


def samples_of(image: np.ndarray) -> bytes:
    """The bytes of ``encode_samples`` from the pixels."""
    return image.astype(">u4").tobytes()
