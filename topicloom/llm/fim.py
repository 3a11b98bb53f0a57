"""Fill-in-the-middle transformation over seekable compressed frames."""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .common import prepare_texts, whole

#: UTF-8 bytes after which a frame is closed: after its last line feed, or inside a longer line before a code point.
FRAME_BYTES = 1 << 16
#: Level of zstandard.
LEVEL = 1
#: Markers before the prefix, the suffix and the middle.
MARKERS = ("<P>", "<S>", "<M>")
#: A frame: line feeds, code points and bytes of the text before it, and its own bytes as one zstandard frame.
FRAME = "struct<feeds: long, chars: long, bytes: long, data: binary>"
FRAMES = pa.list_(pa.struct([("feeds", pa.int64()), ("chars", pa.int64()), ("bytes", pa.int64()), ("data", pa.binary())]))

Frame = dict[str, int | bytes]
Pack = Callable[[bytes], bytes]


def packer() -> Pack:
    import zstandard

    return zstandard.ZstdCompressor(level=LEVEL, write_content_size=True).compress


class FrameWriter:
    """Collects frames and what lies before each."""

    def __init__(self, pack: Pack):
        self.pack, self.frames = pack, []
        self.feeds = self.chars = self.bytes = 0

    def add(self, data: bytes, feeds: int, chars: int, size: int) -> None:
        self.frames.append({"feeds": self.feeds, "chars": self.chars, "bytes": self.bytes, "data": data})
        self.feeds, self.chars, self.bytes = self.feeds + feeds, self.chars + chars, self.bytes + size

    def write(self, body: bytes) -> None:
        if body:
            self.add(self.pack(body), body.count(b"\n"), len(body.decode()), len(body))


class Frames:
    """A stored text; a part of it is read from the frames it lies in, one frame at a time."""

    def __init__(self, frames: list[Frame], feeds: int, chars: int, size: int):
        import zstandard

        self.frames, self.feeds, self.chars, self.size = frames, feeds, chars, size
        self.starts = [f["bytes"] for f in frames]
        self.read = zstandard.ZstdDecompressor().decompress

    def frame(self, i: int) -> bytes:
        return self.read(self.frames[i]["data"])

    def between(self, start: int, end: int) -> Iterator[tuple[int, int, int]]:
        """Frames that bytes ``start`` to ``end`` lie in, each with the part of it that is meant."""
        i = max(0, bisect_right(self.starts, start) - 1)
        while i < len(self.frames) and self.starts[i] < end:
            last = self.starts[i + 1] if i + 1 < len(self.frames) else self.size
            yield i, max(start, self.starts[i]) - self.starts[i], min(end, last) - self.starts[i]
            i += 1

    def stream(self, start: int, end: int) -> Iterator[bytes]:
        for i, a, b in self.between(start, end):
            yield self.frame(i)[a:b]

    def after_units(self, n: int, total: int) -> tuple[int, int]:
        """Bytes and code points of the first ``n`` of ``total`` units; only the frame of the cut is opened."""
        if n == 0:
            return 0, 0
        if n == total:
            return self.size, self.chars
        # the n-th line feed is in the last frame that has fewer than n before it
        i = bisect_right([f["feeds"] for f in self.frames], n - 1) - 1
        body, at = self.frame(i), 0
        for _ in range(n - self.frames[i]["feeds"]):
            at = body.index(b"\n", at) + 1
        return self.starts[i] + at, self.frames[i]["chars"] + len(body[:at].decode())

    def move(self, start: int, end: int, out: FrameWriter, before: bytes) -> bytes:
        """Append ``before`` and a part of the text; whole frames move as they are. Returns bytes still to be written."""
        ends = [*self.frames[1:], {"feeds": self.feeds, "chars": self.chars, "bytes": self.size}]
        for i, a, b in self.between(start, end):
            f, g = self.frames[i], ends[i]
            if a == 0 and b == g["bytes"] - f["bytes"]:
                out.write(before)
                before = b""
                out.add(f["data"], *(g[x] - f[x] for x in ("feeds", "chars", "bytes")))
            else:
                before += self.frame(i)[a:b]
        return before

    def find(self, marker: bytes, start: int = 0) -> int:
        """Byte of the first ``marker`` from ``start`` on, also across frames; -1 if there is none."""
        kept, at = b"", start
        for body in self.stream(start, self.size):
            seen = kept + body
            if (hit := seen.find(marker)) >= 0:
                return at - len(kept) + hit
            at += len(body)
            kept = seen[max(0, len(seen) - len(marker) + 1):]
        return -1


def framed(body: bytes, pack: Pack, frame_bytes: int = FRAME_BYTES) -> list[Frame]:
    """Independent frames that together hold ``body``."""
    out, at = FrameWriter(pack), 0
    while at < len(body):
        end = min(at + frame_bytes, len(body))
        if end < len(body):
            line = body.rfind(b"\n", at, end) + 1
            while not line and end < len(body) and body[end] & 0xC0 == 0x80:
                end += 1
            end = line or end
        out.write(body[at:end])
        at = end
    return out.frames


def store(docs: DataFrame, *, key: str = "doc_id", text: str = "text", frame_bytes: int = FRAME_BYTES,
          markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """``(key, frames, n, feeds, chars, bytes, marked)`` per row of ``docs``, as a written table.

    ``frames`` hold the text as independent zstandard frames, each with the line feeds, code points and bytes before
    it, then come those of the whole text; the joined data of the frames are a zstandard stream of the text. ``n``
    counts its units: lines with their line feed. ``marked`` says whether a marker occurs in it. Null text counts as
    empty and has no frames; keys may be null or repeat, each row is stored by itself; an empty table gives an
    empty one. A text of any length is cut into frames of about ``frame_bytes``. Other columns are ignored.
    """
    prepare_texts(docs.sparkSession)
    key_type = dict(docs.select(key).dtypes)[key]
    marks = [m.encode() for m in markers]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = packer()
        for batch in batches:
            frames, counts, marked = [], [], []
            for t in batch.column(1):
                body = t.as_buffer().to_pybytes()
                feeds = body.count(b"\n")
                frames.append(framed(body, pack, frame_bytes))
                counts.append((feeds + (not body.endswith(b"\n") and bool(body)), feeds, len(body.decode()), len(body)))
                marked.append(any(m in body for m in marks))
            numbers = [pa.array([c[i] for c in counts], pa.int64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(frames, FRAMES), *numbers, pa.array(marked, pa.bool_())],
                                             ["__k", "frames", "n", "feeds", "chars", "bytes", "marked"])

    stored = docs.select(F.col(key).alias("__k"), whole(text).alias("__t")).mapInArrow(
        write, f"__k {key_type}, frames array<{FRAME}>, n long, feeds long, chars long, bytes long, marked boolean")
    return cut(stored, "fim-frames").withColumnRenamed("__k", key)


def draws(key: object, seed: int) -> tuple[int, int, int, int]:
    """Four numbers of 32 bits from the seed and the decimal key; without a key from the seed alone."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
    return tuple(int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12))


def transform(stored: DataFrame, *, key: str = "doc_id", seed: int = 7, share: int = 100, spm_share: int = 50,
              markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """``(key, n, form, prefix_chars, middle_chars, output, feeds, chars, bytes)`` per row of a :func:`store` table.

    Two cuts between units, drawn from seed and key, split a text into prefix, middle and suffix. ``output`` is the
    new text as frames like those of the store, and ``feeds``, ``chars`` and ``bytes`` count it: form ``psm`` is prefix,
    suffix, middle and form ``spm`` suffix, prefix, middle, each after its marker. Empty and marked texts and those
    beyond the ``share`` of 100 are ``plain`` and keep their frames. Frames that no cut touches move as they are;
    only the frames of the cuts are opened and packed anew.
    """
    key_type = dict(stored.select(key).dtypes)[key]
    p, s, m = (x.encode() for x in markers)

    def rearrange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = packer()
        for batch in batches:
            form, before, middle, output, counts = [], [], [], [], []
            for row in batch.to_pylist():
                h1, h2, h3, h4 = draws(row["__k"], seed)
                n, source = row["n"], Frames(row["frames"], row["feeds"], row["chars"], row["bytes"])
                if n == 0 or row["marked"] or h3 % 100 >= share:
                    form.append("plain")
                    before.append(None)
                    middle.append(None)
                    output.append(row["frames"])
                    counts.append((source.feeds, source.chars, source.size))
                    continue
                (x, x_chars), (y, y_chars) = (source.after_units(c, n) for c in sorted((h1 % (n + 1), h2 % (n + 1))))
                prefix, mid, suffix = (p, 0, x), (m, x, y), (s, y, source.size)
                spm = h4 % 100 < spm_share
                out, rest = FrameWriter(pack), b""
                for marker, start, end in ([suffix, prefix, mid] if spm else [prefix, suffix, mid]):
                    rest = source.move(start, end, out, rest + marker)
                out.write(rest)
                form.append("spm" if spm else "psm")
                before.append(x_chars)
                middle.append(y_chars - x_chars)
                output.append(out.frames)
                counts.append((out.feeds, out.chars, out.bytes))
            numbers = [pa.array([c[i] for c in counts], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(form, pa.string()), pa.array(before, pa.int64()), pa.array(middle, pa.int64()),
                 pa.array(output, FRAMES), *numbers],
                ["__k", "n", "form", "prefix_chars", "middle_chars", "output", "feeds", "chars", "bytes"])

    moved = stored.select(F.col(key).alias("__k"), "frames", "n", "feeds", "chars", "bytes", "marked").mapInArrow(
        rearrange, f"__k {key_type}, n long, form string, prefix_chars long, middle_chars long, output array<{FRAME}>, "
                   "feeds long, chars long, bytes long")
    return moved.withColumnRenamed("__k", key)


def restored_parts(output: Frames, form: str, markers: tuple[str, str, str] = MARKERS) -> list[tuple[int, int]]:
    """Byte ranges of ``output`` that, in turn, are the text: found from the markers in it and its form alone."""
    if form == "plain":
        return [(0, output.size)]
    p, s, m = (x.encode() for x in markers)
    first, second = (p, s) if form == "psm" else (s, p)
    split = output.find(second, len(first))
    middle = output.find(m, split + len(second))
    one, two, last = (len(first), split), (split + len(second), middle), (middle + len(m), output.size)
    return [one, last, two] if form == "psm" else [two, last, one]


def _read(moved: DataFrame, read: Callable[[Frames, str], dict[str, str]], names: list[str]) -> DataFrame:
    """A :func:`transform` table without its frames and their counts, with string columns read from them."""
    kept = ["n", "form", "prefix_chars", "middle_chars"]
    key = next(c for c in moved.columns if c not in (*kept, "output", "feeds", "chars", "bytes"))
    key_type = dict(moved.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [read(Frames(o, f, c, b), w) for w, o, f, c, b in
                     zip(*(batch.column(x).to_pylist() for x in ("form", "output", "feeds", "chars", "bytes")))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("__k", *kept)), *(pa.array([x[c] for x in found], pa.string()) for c in names)],
                                             ["__k", *kept, *names])

    schema = f"__k {key_type}, n long, form string, prefix_chars long, middle_chars long, {', '.join(f'{c} string' for c in names)}"
    return moved.withColumnRenamed(key, "__k").mapInArrow(run, schema).withColumnRenamed("__k", key)


def digests(moved: DataFrame, markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """``(key, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256)``: of the output, and of the text rebuilt
    from output and form. Frames are opened in the order of the text that is hashed, one at a time."""
    def hashed(output: Frames, parts: list[tuple[int, int]]) -> str:
        h = hashlib.sha256()
        for part in parts:
            for body in output.stream(*part):
                h.update(body)
        return h.hexdigest()

    def both(output: Frames, form: str) -> dict[str, str]:
        return {"output_sha256": hashed(output, [(0, output.size)]), "restored_sha256": hashed(output, restored_parts(output, form, markers))}

    return _read(moved, both, ["output_sha256", "restored_sha256"])


def texts(moved: DataFrame, markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """``(key, n, form, prefix_chars, middle_chars, output_text, restored_text)`` of a :func:`transform` table."""
    def both(output: Frames, form: str) -> dict[str, str]:
        parts = {"output_text": [(0, output.size)], "restored_text": restored_parts(output, form, markers)}
        return {c: b"".join(b for x in where for b in output.stream(*x)).decode() for c, where in parts.items()}

    return _read(moved, both, ["output_text", "restored_text"])
