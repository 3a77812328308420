import hashlib
import zlib

import numpy as np
import pytest

from docloom.llm.jpeg import Component, Image, Reader, Scan, decode, encode, zigzag
from docloom.llm.media import jpeg_tensors, op10_media_columns, padded, read_back, store, tensor_feature


def _photo(seed, height=37, width=45, zero=0.8):
    rng = np.random.default_rng(seed)
    image = Image(height, width, [Component(2, 2, np.arange(1, 65)), Component(1, 1, np.full(64, 3)), Component(1, 1, np.full(64, 3))]).lay_out()
    for c in image.parts:
        c.coefs[...] = rng.integers(-40, 40, c.coefs.shape) * (rng.random(c.coefs.shape) > zero)
        c.coefs[..., 0] = rng.integers(-200, 200, c.coefs.shape[:2])
    return image


SCRIPT = [Scan((0, 1, 2), 0, 0, 0, 1), *[Scan((k,), 1, 5, 0, 2) for k in range(3)], *[Scan((k,), 6, 63, 0, 2) for k in range(3)], *[Scan((k,), 1, 63, 2, 1) for k in range(3)], Scan((0, 1, 2), 0, 0, 1, 0), *[Scan((k,), 1, 63, 1, 0) for k in range(3)]]


@pytest.mark.parametrize("zero", [0.2, 0.8, 0.99])
def test_progressive_scans_round_trip(zero):
    for seed in range(4):
        image = _photo(seed, zero=zero)
        got = decode(encode(image, SCRIPT))
        for a, b in zip(image.parts, got.parts, strict=True):
            rows, cols = a.size  # blocks outside the component's own grid hold only DC
            assert np.array_equal(a.coefs[:rows, :cols], b.coefs[:rows, :cols])


def test_tensor_is_the_inverse_transform():
    image = _photo(1)
    y = image.parts[0]
    rgb = decode(encode(image, SCRIPT)).rgb()
    assert rgb.shape == (37, 45, 3)
    block = np.zeros(64)
    block[zigzag()] = y.coefs[0, 0] * y.quant
    x, u = np.arange(8)[:, None], np.arange(8)[None, :]
    basis = np.cos((2 * x + 1) * u * np.pi / 16) * np.where(u == 0, np.sqrt(0.125), 0.5)
    luma = np.clip(np.rint(basis @ block.reshape(8, 8) @ basis.T) + 128, 0, 255)
    grey = Image(8, 8, [Component(1, 1, y.quant, coefs=y.coefs[:1, :1].copy())])
    assert np.abs(grey.lay_out().rgb()[:, :, 0] - luma).max() <= 1


class PlainDecoder:
    """Another reader, bit by bit: coefficient planes of a progressive file of whole MCUs, then colours pixel by pixel."""

    def __init__(self, data):
        at, self.tables, self.quants = 2, {}, {}
        while data[at + 1] != 0xD9:
            marker, n = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
            body, at = data[at + 4 : at + 2 + n], at + 2 + n
            if marker == 0xDB:
                self.quants[body[0]] = list(body[1:65])
            elif marker == 0xC4:
                code, k, table = 0, 17, {}
                for size in range(1, 17):
                    for _ in range(body[size]):
                        table[format(code, f"0{size}b")] = body[k]
                        code, k = code + 1, k + 1
                    code *= 2
                self.tables[body[0]] = table
            elif marker == 0xC2:
                self.height, self.width = int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big")
                self.kinds = [(body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(body[5])]
                top = max(h for h, _, _ in self.kinds)
                self.grids = [(self.height * v // (8 * top), self.width * h // (8 * top)) for h, v, _ in self.kinds]
                self.planes = [{(r, c): [0] * 64 for r in range(g[0]) for c in range(g[1])} for g in self.grids]
            elif marker == 0xDA:
                end = at
                while not (data[end] == 0xFF and data[end + 1]):
                    end += 1
                self.bits, self.pos = "".join(format(b, "08b") for b in data[at:end].replace(b"\xff\0", b"\xff")), 0
                parts, (ss, se, a) = [body[1 + 2 * i] - 1 for i in range(body[0])], body[1 + 2 * body[0] :]
                self.scan(parts, ss, se, a >> 4, a & 15)
                at = end

    def take(self, n):
        self.pos += n
        return int(self.bits[self.pos - n : self.pos] or "0", 2)

    def value(self, n):
        v = self.take(n)
        return v if not n or v >= 1 << (n - 1) else v - (1 << n) + 1

    def symbol(self, kind):
        end = self.pos + 1
        while self.bits[self.pos : end] not in self.tables[kind]:
            end += 1
        name, self.pos = self.bits[self.pos : end], end
        return self.tables[kind][name]

    def scan(self, parts, ss, se, ah, al):
        if ss == 0:
            last = dict.fromkeys(parts, 0)
            rows, cols = self.grids[0][0] // self.kinds[0][1], self.grids[0][1] // self.kinds[0][0]
            for r in range(rows):
                for c in range(cols):
                    for k in parts:
                        h, v, _ = self.kinds[k]
                        for y in range(v):
                            for x in range(h):
                                block = self.planes[k][r * v + y, c * h + x]
                                if ah:
                                    block[0] |= self.take(1) << al
                                else:
                                    last[k] += self.value(self.symbol(0))
                                    block[0] = last[k] << al
            return
        run = 0
        for place in sorted(self.planes[parts[0]]):
            block, k = self.planes[parts[0]][place], ss
            while not run and k <= se:
                zeros, n = divmod(self.symbol(16), 16)
                if not n and zeros < 15:
                    run = (1 << zeros) + self.take(zeros)
                    break
                new = 0 if not n else self.value(n) << al if not ah else (1 << al) * (1 if self.take(1) else -1)
                while k <= se:
                    if ah and block[k]:
                        block[k] += self.take(1) * (1 << al) * (1 if block[k] > 0 else -1)
                    elif not zeros:
                        break
                    else:
                        zeros -= 1
                    k += 1
                if k <= se:
                    block[k] = new or block[k]
                k += 1
            if run:
                for j in range(k, se + 1):
                    if ah and block[j]:
                        block[j] += self.take(1) * (1 << al) * (1 if block[j] > 0 else -1)
                run -= 1

    def rgb(self):
        basis = [[np.cos((2 * x + 1) * u * np.pi / 16) * (0.5 if u else 0.125**0.5) for u in range(8)] for x in range(8)]
        order, samples = zigzag().tolist(), []
        for (_, _, q), plane, grid in zip(self.kinds, self.planes, self.grids, strict=True):
            out = np.zeros((grid[0] * 8, grid[1] * 8))
            for (r, c), block in plane.items():
                square = np.zeros((8, 8))
                for k, value in enumerate(block):
                    square[order[k] // 8, order[k] % 8] = value * self.quants[q][k]
                out[r * 8 : r * 8 + 8, c * 8 : c * 8 + 8] = np.clip(np.floor(np.array(basis) @ square @ np.array(basis).T + 128.5), 0, 255)
            samples.append(out)
        out = np.zeros((self.height, self.width, 3))
        for y in range(self.height):
            for x in range(self.width):
                lum, cb, cr = (samples[k][y * samples[k].shape[0] // self.height, x * samples[k].shape[1] // self.width] - 128 * bool(k) for k in range(3))
                out[y, x] = lum + 1.402 * cr, lum - 0.344136 * cb - 0.714136 * cr, lum + 1.772 * cb
        return np.clip(out, 0, 255)


def test_another_decoder_reads_the_same():
    rng = np.random.default_rng(3)
    whole = Image(32, 48, [Component(2, 2, np.arange(1, 65)), Component(1, 1, np.full(64, 3)), Component(1, 1, np.full(64, 3))]).lay_out()
    for c in whole.parts:
        c.coefs[...] = rng.integers(-40, 40, c.coefs.shape) * (rng.random(c.coefs.shape) > 0.8)
        c.coefs[..., 0] = rng.integers(-200, 200, c.coefs.shape[:2])
    for data in (encode(whole, SCRIPT), store(padded(bytes(rng.integers(0, 256, 1500, np.uint8)))), store(padded(b"a text"))):
        own, plain = decode(data), PlainDecoder(data)
        for part, plane in zip(own.parts, plain.planes, strict=True):
            assert {(r, c): part.coefs[r, c].tolist() for r, c in plane} == plane
        assert np.abs(own.rgb() - plain.rgb()).max() < 1 + 1.772 + 0.6  # a step of luma, one of chroma, and the rounding


def test_chroma_and_codes_are_read(monkeypatch):
    read = []
    monkeypatch.setattr(Reader, "symbol", lambda self, codes, f=Reader.symbol: read.append(1) or f(self, codes))
    data = padded("The payload of a text, é and so on. ".encode() * 40)
    image = decode(store(data))
    rgb = image.rgb()
    assert read_back(image, len(data)) == data and len(read) == sum(c.coefs.shape[0] * c.coefs.shape[1] for c in image.parts)
    assert (rgb[..., 0] != rgb[..., 1]).any() and (rgb[..., 2] != rgb[..., 1]).any()
    plain = PlainDecoder(store(data))
    flat = [x - 256 if k else x + 128 for plane in plain.planes for place in sorted(plane) for k, x in enumerate(plane[place])]
    assert bytes(flat[: len(data)]) == data
    shape, means = tensor_feature(rgb).split(":")
    assert shape == f"{plain.height}x{plain.width}x3" and np.abs(np.array(means.split(","), int) - plain.rgb().mean((0, 1))).max() <= 2


def test_payload_round_trip_and_contract(spark):
    texts = [None, "", "a", "é" * 63, "x" * 64, "long " * 40_000, bytes(range(1, 128)).decode() * 9]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in op10_media_columns(docs).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        data = padded((t or "").encode())
        media = store(data)
        assert read_back(decode(media), len(data)) == data and len(data) % 64 == 0 < len(data)
        assert (got[i]["n_bytes"], got[i]["payload_bytes"], got[i]["media_bytes"]) == (len((t or "").encode()), len(data), len(media))
        assert got[i]["payload_sha256"] == hashlib.sha256(data).hexdigest() and got[i]["tail_crc32"] == zlib.crc32(data[-64:])
        assert got[i]["media_sha256"] == hashlib.sha256(media).hexdigest()
    assert got[0]["feature"] == got[1]["feature"]


def test_media_table(spark):
    image = _photo(3)
    rows = [(1, encode(image, SCRIPT)), (2, None), (3, b"no jpeg")]
    got = {r["id"]: r for r in jpeg_tensors(spark.createDataFrame(rows, "id long, jpeg binary")).collect()}
    assert bytes(got[1]["_rgb"]) == image.rgb().tobytes() and got[1]["_rgb_height"] == 37
    assert got[2]["_rgb"] is None and got[2]["_rgb_error"] is None
    assert got[3]["_rgb"] is None and got[3]["_rgb_error"]
    odd = spark.sql("SELECT named_struct('a b', 1) AS `x y`, 'old' AS _rgb, 7 AS _rgb_error, cast(null AS binary) AS jpeg")
    assert jpeg_tensors(odd).columns == ["x y", "jpeg", "_rgb_height", "_rgb_width", "_rgb", "_rgb_error"] and jpeg_tensors(odd).first()["_rgb"] is None
    assert jpeg_tensors(odd.limit(0)).count() == op10_media_columns(spark.sql("SELECT 1 AS doc_id, 'x' AS text").limit(0)).count() == 0
