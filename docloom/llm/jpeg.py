"""Progressive JPEG in numpy: scans are accumulated into coefficient arrays, which become full-resolution RGB tensors.

Coefficients are integers in zigzag order, quantised. A scan holds a spectral band (`ss` to `se`) of one component, or the
DC of several, down to bit `al`; a first scan (`ah` = 0) brings the upper bits, each later one a single bit more. Where a
scan's symbols are all alike its bits form a matrix, which numpy reads or writes at once; the reader checks that every
code in it is the expected one and otherwise reads symbol by symbol.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np


@lru_cache(1)
def zigzag() -> np.ndarray:
    """For each place of the zigzag order, row * 8 + column: diagonals, up and down in turn."""
    cells = sorted(((r, c) for r in range(8) for c in range(8)), key=lambda x: (x[0] + x[1], x[0] if (x[0] + x[1]) % 2 else x[1]))
    return np.array([r * 8 + c for r, c in cells])


@lru_cache(1)
def inverse_dct() -> np.ndarray:
    """64 x 64 integers: zigzag coefficient to sample, times 2**12; products with integers below 2**40 stay exact in doubles."""
    x, u = np.arange(8)[:, None], np.arange(8)[None, :]
    basis = np.cos((2 * x + 1) * u * np.pi / 16) * np.where(u == 0, np.sqrt(0.125), 0.5)
    both = np.einsum("xu,yv->uvxy", basis, basis).reshape(64, 64)
    return np.rint(both[zigzag()] * 4096)


@dataclass
class Component:
    h: int
    v: int
    quant: np.ndarray
    #: Blocks (rows, columns) of the component alone, and padded to whole MCUs.
    size: tuple[int, int] = (0, 0)
    padded: tuple[int, int] = (0, 0)
    coefs: np.ndarray = field(default_factory=lambda: np.zeros((0, 0, 64), np.int32))


@dataclass
class Image:
    height: int
    width: int
    parts: list[Component]

    def lay_out(self) -> Image:
        """Set the block grids; coefficient arrays of another shape are made anew."""
        hm, vm = max(c.h for c in self.parts), max(c.v for c in self.parts)
        across, down = -(-self.width // (8 * hm)), -(-self.height // (8 * vm))
        for c in self.parts:
            c.size = (-(-(-(-self.height * c.v // vm)) // 8), -(-(-(-self.width * c.h // hm)) // 8))
            c.padded = (down * c.v, across * c.h)
            if c.coefs.shape != (*c.padded, 64):
                c.coefs = np.zeros((*c.padded, 64), np.int32)
        return self

    def order(self, which: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
        """Component and block number of each block of a scan, in the order it is coded in."""
        return _order(which, tuple((self.parts[k].h, self.parts[k].v, self.parts[k].size, self.parts[k].padded) for k in which))

    def rgb(self) -> np.ndarray:
        """Height x width x 3 bytes; chroma samples are repeated up to full resolution. One component gives grey."""
        hm, vm = max(c.h for c in self.parts), max(c.v for c in self.parts)
        planes = []
        for c in self.parts:
            rows, cols = c.padded
            if len(self.parts) > 1 and not c.coefs.any():
                planes.append(np.full((1, 1), 128, np.int32))  # the same everywhere
                continue
            flat = (c.coefs.reshape(-1, 64) * c.quant).astype(np.float64) @ inverse_dct()
            flat += 2048 + 128 * 4096
            samples = np.clip(flat, 0, 256 * 4096 - 1).astype(np.int32) >> 12
            plane = samples.reshape(rows, cols, 8, 8).transpose(0, 2, 1, 3).reshape(rows * 8, cols * 8)
            plane = plane.repeat(vm // c.v, 0).repeat(hm // c.h, 1) if (c.h, c.v) != (hm, vm) else plane
            planes.append(plane[: self.height, : self.width])
        if len(planes) == 1:
            return np.repeat(planes[0].astype(np.uint8)[:, :, None], 3, 2)
        # The JFIF colour equations, times 2**16.
        y, cb, cr = planes[0], planes[1] - 128, planes[2] - 128
        out = np.empty((self.height, self.width, 3), np.uint8)
        out[:, :, 0] = np.clip(y + (91881 * cr + 32768 >> 16), 0, 255)
        out[:, :, 1] = np.clip(y - (22554 * cb + 46802 * cr + 32768 >> 16), 0, 255)
        out[:, :, 2] = np.clip(y + (116130 * cb + 32768 >> 16), 0, 255)
        return out


@lru_cache(256)
def _order(which: tuple[int, ...], grids: tuple) -> tuple[np.ndarray, np.ndarray]:
    if len(which) == 1:
        _, _, (rows, cols), (_, across) = grids[0]
        at = (np.arange(rows)[:, None] * across + np.arange(cols)).ravel()
        return np.full(len(at), which[0]), at
    of, at = [], []
    for k, (h, v, _, (down, across)) in zip(which, grids, strict=True):
        grid = np.arange(down * across).reshape(down // v, v, across // h, h)
        at.append(grid.transpose(0, 2, 1, 3).reshape(-1, h * v))
        of.append(np.full(at[-1].shape, k))
    return np.concatenate(of, 1).ravel(), np.concatenate(at, 1).ravel()


@dataclass(frozen=True)
class Scan:
    parts: tuple[int, ...]
    ss: int
    se: int
    ah: int
    al: int


# ---------------------------------------------------------------- writing


class Bits:
    """Bits of a scan, as pieces of 0 and 1."""

    def __init__(self):
        self.all: list[np.ndarray] = []
        self.few: list[int] = []

    def put(self, value: int, n: int) -> None:
        self.few += [value >> k & 1 for k in range(n - 1, -1, -1)]

    def matrix(self, bits: np.ndarray) -> None:
        self.all += [np.array(self.few, np.uint8), bits.ravel()]
        self.few = []

    def stuffed(self) -> bytes:
        self.matrix(np.zeros(0, np.uint8))
        bits = np.concatenate(self.all)
        packed = np.packbits(np.concatenate([bits, np.ones(-len(bits) % 8, np.uint8)]))
        return packed.tobytes().replace(b"\xff", b"\xff\x00")


def _binary(values: np.ndarray, n: int) -> np.ndarray:
    """The low n (at most 16) bits of each value, as a matrix."""
    if n == 8:
        return np.unpackbits(values.astype(np.uint8)).reshape(-1, 8)
    return np.unpackbits(values.astype(">u2").view(np.uint8).reshape(-1, 2), axis=1)[:, 16 - n :]


def _amplitude(v: int) -> tuple[int, int]:
    n = abs(v).bit_length()
    return n, v if v > 0 else v + (1 << n) - 1


def _dc_bits(values: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, bytes]:
    """First scan of the DC: each component's steps as sizes and amplitudes, all at once; the bits and the code table."""
    step = np.empty(len(values), np.int64)
    for k in np.unique(of):
        step[of == k] = np.diff(values[of == k], prepend=0)
    size = np.frexp(np.abs(step))[1].astype(np.int64)
    code, n, table = _codes(np.unique(size).tolist())
    most = int(size.max(initial=0))
    names = np.array([code.get(k, 0) for k in range(most + 1)])[size]
    extra = np.where(step > 0, step, step + (1 << size) - 1) << (most - size)
    bits = np.concatenate([names[:, None] >> np.arange(n - 1, -1, -1) & 1, extra[:, None] >> np.arange(most - 1, -1, -1) & 1], 1).astype(np.uint8)
    return bits[np.arange(n + most) < (n + size)[:, None]], table


def _end_run(out: list, run: int, pending: list) -> None:
    if run:
        n = run.bit_length() - 1
        out.append((n << 4, run - (1 << n), n, tuple(pending)))
        pending.clear()


def _symbols_ac(blocks: np.ndarray, al: int) -> list:
    """First scan of a band: (run of zeros, size) with the amplitude, and runs of blocks that are at their end."""
    out, ended = [], 0
    for block in blocks.tolist():
        zeros = 0
        for c in block:
            v = (abs(c) >> al) * (1 if c > 0 else -1)
            if not v:
                zeros += 1
                continue
            _end_run(out, ended, [])
            ended = 0
            while zeros > 15:
                out.append((0xF0, 0, 0, ()))
                zeros -= 16
            n, bits = _amplitude(v)
            out.append((zeros << 4 | n, bits, n, ()))
            zeros = 0
        if zeros:
            ended += 1
            if ended == 0x7FFF:
                _end_run(out, ended, [])
                ended = 0
    _end_run(out, ended, [])
    return out


def _symbols_refine(blocks: np.ndarray, al: int) -> list:
    """Later scan of a band: new coefficients as symbols, one more bit of each known one after the symbol they follow."""
    out, ended, pending = [], 0, []
    for block in blocks.tolist():
        size = [abs(c) >> al for c in block]
        newest = max((k for k, t in enumerate(size) if t == 1), default=-1)
        zeros, bits = 0, []
        for k, t in enumerate(size):
            if not t:
                zeros += 1
                continue
            while zeros > 15 and k <= newest:
                _end_run(out, ended, pending)
                ended = 0
                out.append((0xF0, 0, 0, tuple(bits)))
                zeros, bits = zeros - 16, []
            if t > 1:
                bits.append(t & 1)
                continue
            _end_run(out, ended, pending)
            ended = 0
            out.append((zeros << 4 | 1, int(block[k] > 0), 1, tuple(bits)))
            zeros, bits = 0, []
        if zeros or bits:
            ended += 1
            pending += bits
            if ended == 0x7FFF:
                _end_run(out, ended, pending)
                ended = 0
    _end_run(out, ended, pending)
    return out


@lru_cache(64)
def _codes_of(symbols: tuple[int, ...]) -> tuple[dict[int, int], int, bytes]:
    """Codes of one length for the symbols, and the table's bytes (counts by length, symbols)."""
    n = max(1, len(symbols).bit_length())
    if len(symbols) > 254:
        n = 9
    counts = [0] * 16
    counts[n - 1] = len(symbols)
    return {s: i for i, s in enumerate(symbols)}, n, bytes(counts) + bytes(symbols)


def _codes(symbols: list[int]) -> tuple[dict[int, int], int, bytes]:
    return _codes_of(tuple(symbols))


def _segment(marker: int, body: bytes) -> bytes:
    return bytes([0xFF, marker]) + struct.pack(">H", len(body) + 2) + body


def _rows(blocks: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The blocks in this order, without a copy where it is their own."""
    return blocks if len(at) == len(blocks) and at[0] == 0 and at[-1] == len(at) - 1 and (np.diff(at) == 1).all() else blocks[at]


def write_scan(image: Image, scan: Scan) -> bytes:
    of, at = image.order(scan.parts)
    coefs = [c.coefs.reshape(-1, 64) for c in image.parts]
    band = np.zeros((0, 1), np.int32)
    bits, table = Bits(), b""
    if scan.ss == 0:
        dc = np.empty(len(at), np.int32)
        for k in scan.parts:
            dc[of == k] = coefs[k][at[of == k], 0] >> scan.al
        if scan.ah:
            bits.matrix((dc & 1).astype(np.uint8))
            symbols = []
        elif not dc.any():
            code, n, table = _codes([0])
            bits.matrix(np.zeros((len(dc), n), np.uint8))
            symbols = []
        else:
            found, table = _dc_bits(dc, of)
            bits.matrix(found)
            symbols = []
    else:
        band = _rows(coefs[scan.parts[0]], at)[:, scan.ss : scan.se + 1]
        size = np.abs(band) >> scan.al
        low, high = (int(size.min()), int(size.max())) if size.size else (0, 0)
        if scan.ah and low > 1:
            code, n, table = _codes([0])  # each block: end of band, then a bit of every coefficient
            bits.matrix(np.concatenate([np.zeros((len(band), n), np.uint8), (size & 1).astype(np.uint8)], 1))
            symbols = []
        elif not scan.ah and low and low.bit_length() == high.bit_length() <= 10:
            many = low.bit_length()
            code, n, table = _codes([many])
            values = np.where(band > 0, size, (1 << many) - 1 - size).ravel()
            bits.matrix(np.concatenate([np.zeros((values.size, n), np.uint8), _binary(values, many)], 1))
            symbols = []
        else:
            symbols = _symbols_refine(band, scan.al) if scan.ah else _symbols_ac(band, scan.al)
    if symbols:
        code, n, table = _codes(sorted({s[0] for s in symbols}))
        for s, extra, many, after in symbols:
            bits.put(code[s], n)
            bits.put(extra, many)
            bits.few += after
    kind = 0 if scan.ss == 0 else 16
    out = _segment(0xC4, bytes([kind]) + table) if table else b""
    spec = bytes([len(scan.parts)]) + b"".join(bytes([k + 1, 0]) for k in scan.parts) + bytes([scan.ss, scan.se, scan.ah << 4 | scan.al])
    return out + _segment(0xDA, spec) + bits.stuffed()


def encode(image: Image, scans: list[Scan]) -> bytes:
    """A progressive file with these scans."""
    image.lay_out()
    out = [b"\xff\xd8", _segment(0xE0, b"JFIF\0\1\1\0\0\1\0\1\0\0")]
    tables = []
    for c in image.parts:
        if not any(np.array_equal(c.quant, t) for t in tables):
            tables.append(c.quant)
            out.append(_segment(0xDB, bytes([len(tables) - 1]) + c.quant.astype(np.uint8).tobytes()))
    named = b"".join(bytes([i + 1, c.h << 4 | c.v, next(k for k, t in enumerate(tables) if np.array_equal(t, c.quant))]) for i, c in enumerate(image.parts))
    out.append(_segment(0xC2, struct.pack(">BHHB", 8, image.height, image.width, len(image.parts)) + named))
    return b"".join(out + [write_scan(image, s) for s in scans] + [b"\xff\xd9"])


# ---------------------------------------------------------------- reading


class Codes:
    """A Huffman table: symbol and length for each run of as many bits as its longest code has."""

    def __init__(self, counts: bytes, symbols: bytes):
        code, k, entries = 0, 0, []
        for n in range(1, 17):
            for _ in range(counts[n - 1]):
                entries.append((code, n, symbols[k]))
                code, k = code + 1, k + 1
            code <<= 1
        self.entries = entries
        self.width = max((n for _, n, _ in entries), default=1)
        self._table: list[tuple[int, int] | None] | None = None

    @property
    def table(self) -> list:
        if self._table is None:
            self._table = [None] * (1 << self.width)
            for code, n, symbol in self.entries:
                first = code << (self.width - n)
                self._table[first : first + (1 << (self.width - n))] = [(symbol, n)] * (1 << (self.width - n))
        return self._table

    def first(self, data: np.ndarray) -> tuple[int, int, int] | None:
        """Code, length and symbol at the start of the bits."""
        head = int.from_bytes(data[:2].tobytes().ljust(2, b"\xff"), "big")
        return next(((c, n, s) for c, n, s in self.entries if head >> (16 - n) == c), None)


@lru_cache(256)
def _table_of(counts: bytes, symbols: bytes) -> Codes:
    return Codes(counts, symbols)


class Reader:
    """Bits of one interval, one after the other; beyond the end come ones."""

    def __init__(self, data: bytes):
        self.data, self.at = data + b"\xff" * 8, 0

    def bits(self, n: int) -> int:
        if not n:
            return 0
        i = self.at >> 3
        out = int.from_bytes(self.data[i : i + 4], "big") >> (32 - n - (self.at & 7)) & (1 << n) - 1
        self.at += n
        return out

    def symbol(self, codes: Codes) -> int:
        i = self.at >> 3
        found = codes.table[int.from_bytes(self.data[i : i + 3], "big") >> (24 - codes.width - (self.at & 7)) & (1 << codes.width) - 1]
        if found is None:
            raise ValueError("not a code of the table")
        self.at += found[1]
        return found[0]

    def value(self, n: int) -> int:
        v = self.bits(n)
        return v if not n or v >> (n - 1) else v - (1 << n) + 1


def _alike(data: bytes, count: int, codes: Codes, tail: int | None) -> tuple[int, np.ndarray] | None:
    """If the interval is `count` times the same symbol, each with equally many bits after it: the symbol and those bits."""
    raw = np.frombuffer(data, np.uint8)
    found = codes.first(raw) if len(raw) else None
    if found is None:
        return None
    code, n, symbol = found
    after = symbol if tail is None else tail
    total = count * (n + after)
    if symbol > 15 or len(raw) != (total + 7) // 8:
        return None
    bits = np.unpackbits(raw, count=total).reshape(count, n + after)
    if (bits[:, :n] != np.array([code >> k & 1 for k in range(n - 1, -1, -1)], np.uint8)).any():
        return None
    return symbol, bits[:, n:]


def _whole(bits: np.ndarray) -> np.ndarray:
    """Each row of at most 16 bits as a number."""
    n = bits.shape[1]
    if n == 8:
        return np.packbits(bits).astype(np.int32)
    packed = np.packbits(bits, axis=1).astype(np.int32)
    return packed[:, 0] >> (8 - n) if n <= 8 else (packed[:, 0] << 8 | packed[:, 1]) >> (16 - n)


def _read_ac_first(r: Reader, codes: Codes, block: np.ndarray, scan: Scan, ended: int) -> int:
    if ended:
        return ended - 1
    k = scan.ss
    while k <= scan.se:
        zeros, n = divmod(r.symbol(codes), 16)
        if n:
            k += zeros
            block[k] = r.value(n) * (1 << scan.al)
            k += 1
        elif zeros == 15:
            k += 16
        else:
            return (1 << zeros) + r.bits(zeros) - 1
    return 0


def _read_ac_refine(r: Reader, codes: Codes, block: np.ndarray, scan: Scan, ended: int) -> int:
    k, one = scan.ss, 1 << scan.al

    def more(k: int) -> None:
        if r.bits(1):
            block[k] += one if block[k] > 0 else -one

    while not ended and k <= scan.se:
        zeros, n = divmod(r.symbol(codes), 16)
        new = 0
        if n:
            new = one if r.bits(1) else -one
        elif zeros < 15:
            ended = (1 << zeros) + r.bits(zeros)
            break
        while k <= scan.se:
            if block[k]:
                more(k)
            elif not zeros:
                break
            else:
                zeros -= 1
            k += 1
        if new and k <= scan.se:
            block[k] = new
        k += 1
    if not ended:
        return 0
    for j in range(k, scan.se + 1):
        if block[j]:
            more(j)
    return ended - 1


def read_scan(image: Image, scan: Scan, data: bytes, dc: dict, ac: Codes | None, interval: int) -> None:
    """Add what the scan holds to the coefficient arrays. `interval`: MCUs between restarts, or 0."""
    of, at = image.order(scan.parts)
    each = sum(image.parts[k].h * image.parts[k].v for k in scan.parts) if len(scan.parts) > 1 else 1
    step = interval * each or len(at)
    flat = [c.coefs.reshape(-1, 64) for c in image.parts]
    chunks = _intervals(data) if interval else [data.replace(b"\xff\x00", b"\xff")]
    for i, chunk in zip(range(0, len(at), step or 1), chunks, strict=False):
        part, where = of[i : i + step], at[i : i + step]
        if scan.ss == 0:
            if scan.ah:
                bits = np.unpackbits(np.frombuffer(chunk, np.uint8), count=len(where)).astype(np.int32) << scan.al
                for k in scan.parts:
                    flat[k][where[part == k], 0] |= bits[part == k]
                continue
            only = next(iter({id(dc[k]): dc[k] for k in scan.parts}.values())) if len({id(dc[k]) for k in scan.parts}) == 1 else None
            if only and (same := _alike(chunk, len(where), only, None)) and same[0] == 0:
                for k in scan.parts:
                    flat[k][where[part == k], 0] = 0
                continue
            r, last = Reader(chunk), dict.fromkeys(scan.parts, 0)
            for k, b in zip(part.tolist(), where.tolist(), strict=True):
                last[k] += r.value(r.symbol(dc[k]))
                flat[k][b, 0] = last[k] * (1 << scan.al)
            continue
        blocks, wide = flat[scan.parts[0]], scan.se - scan.ss + 1
        if not scan.ah:
            same = _alike(chunk, len(where) * wide, ac, None)
            if same and same[0]:
                n, v = same[0], _whole(same[1])
                v = np.where(v >> (n - 1), v, v - (1 << n) + 1) * (1 << scan.al)
                blocks[where, scan.ss : scan.se + 1] = v.reshape(-1, wide)
                continue
        elif _rows(blocks, where)[:, scan.ss : scan.se + 1].all() and (same := _alike(chunk, len(where), ac, wide)) and same[0] == 0:
            band = _rows(blocks, where)[:, scan.ss : scan.se + 1]
            blocks[where, scan.ss : scan.se + 1] = band + np.sign(band) * (same[1].astype(np.int32) << scan.al)
            continue
        r, ended = Reader(chunk), 0
        read = _read_ac_refine if scan.ah else _read_ac_first
        for b in where.tolist():
            ended = read(r, ac, blocks[b], scan, ended)


def _intervals(data: bytes) -> list[bytes]:
    """Entropy-coded data between restart markers, without stuffed zeros."""
    out, start, i = [], 0, data.find(b"\xff")
    while 0 <= i < len(data) - 1:
        if 0xD0 <= data[i + 1] <= 0xD7:
            out.append(data[start:i])
            start = i + 2
        i = data.find(b"\xff", i + 2)
    return [x.replace(b"\xff\x00", b"\xff") for x in [*out, data[start:]]]


def _scan_end(data: bytes, at: int) -> int:
    """Where the next marker that is neither a stuffed byte nor a restart begins."""
    while True:
        at = data.find(b"\xff", at)
        if at < 0 or at + 1 >= len(data):
            return len(data)
        if data[at + 1] == 0 or 0xD0 <= data[at + 1] <= 0xD7:
            at += 2
        else:
            return at


def decode(data: bytes) -> Image:
    """All scans of a progressive file, accumulated."""
    if data[:2] != b"\xff\xd8":
        raise ValueError("no start of image")
    at, quants, tables, image, interval, names = 2, {}, {}, None, 0, {}
    while at + 4 <= len(data):
        marker, length = data[at + 1], struct.unpack(">H", data[at + 2 : at + 4])[0]
        body = data[at + 4 : at + 2 + length]
        at += 2 + length
        if marker == 0xDB:
            while body:
                wide = 1 + (body[0] >> 4)
                quants[body[0] & 15] = np.frombuffer(body[1 : 1 + 64 * wide], ">u2" if wide == 2 else np.uint8).astype(np.int32)
                body = body[1 + 64 * wide :]
        elif marker == 0xC4:
            while body:
                n = sum(body[1:17])
                tables[body[0] >> 4, body[0] & 15] = _table_of(body[1:17], body[17 : 17 + n])
                body = body[17 + n :]
        elif marker == 0xDD:
            interval = struct.unpack(">H", body)[0]
        elif marker == 0xC2:
            _, height, width, n = struct.unpack(">BHHB", body[:6])
            spec = [body[6 + 3 * i : 9 + 3 * i] for i in range(n)]
            names = {s[0]: i for i, s in enumerate(spec)}
            image = Image(height, width, [Component(s[1] >> 4, s[1] & 15, quants[s[2]]) for s in spec]).lay_out()
        elif 0xC0 <= marker <= 0xCF and marker != 0xCC:
            raise ValueError("not a progressive file")
        elif marker == 0xDA:
            n = body[0]
            parts = tuple(names[body[1 + 2 * i]] for i in range(n))
            ids = [body[2 + 2 * i] for i in range(n)]
            ss, se, bits = body[1 + 2 * n : 4 + 2 * n]
            end = _scan_end(data, at)
            read_scan(image, Scan(parts, ss, se, bits >> 4, bits & 15), data[at:end], {p: tables.get((0, i >> 4)) for p, i in zip(parts, ids, strict=True)}, tables.get((1, ids[0] & 15)), interval)
            at = end
        elif marker == 0xD9:
            break
    if image is None:
        raise ValueError("no frame")
    return image
