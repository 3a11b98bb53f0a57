"""Fill-in-the-middle over seekable frames: exact texts, exact way back, and frames that cuts do not touch."""

import hashlib

import pytest
import zstandard

import brute
from topicloom.llm import fim

LINES = "\n".join(f"line {i} é\U0001f600 {'x' * (i % 90)}" for i in range(4_000))
TEXTS = [(1, None), (2, ""), (3, "\n"), (4, "\n\n\n"), (5, "one line"), (6, "a\nb"), (7, "a\nb\n"), (8, "has <P> inside\nx"), (9, "<S>"), (10, "x<M>\n"),
         (11, "é\U0001f600" * 50_000), (12, LINES), (13, LINES + "\n"), (None, "no key\nat all\n"), (14, "< P >\n<p>\n<S"), (14, "other\ntext\n\n"),
         (14, "other\ntext\n\n"), (15, "a\r\nb c\x0bd\ne"), *[(100 + i, "\n".join(f"{j} {i}" for j in range(i))) for i in range(60)]]


@pytest.fixture(scope="module", params=[1 << 16, 7])
def moved(request, spark):
    docs = spark.createDataFrame([(k, t, "x", 1, "y") for k, t in TEXTS], "doc_id long, text string, frames string, n int, output string")
    return fim.transform(fim.store(docs, frame_bytes=request.param)).cache()


def test_texts(moved):
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output_text) for r in fim.texts(moved).collect()), key=str)
    assert got == sorted(((k, *brute.middle(k, t)) for k, t in TEXTS), key=str)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    assert sorted((r.doc_id, r.restored_text) for r in fim.texts(moved).collect() if r.doc_id) == sorted((k, t or "") for k, t in TEXTS if k)


def test_digests(moved):
    sha = {(k, brute.sha(brute.middle(k, t)[4]), brute.sha(t or "")) for k, t in TEXTS}
    assert {(r.doc_id, r.output_sha256, r.restored_sha256) for r in fim.digests(moved).collect()} == sha


def test_output_is_a_stream_with_true_counts(moved):
    """The joined frames are one zstandard stream, and each frame says what lies before it."""
    for r in moved.collect():
        seen = b""
        for f in r.output:
            assert (f.feeds, f.chars, f.bytes) == (seen.count(b"\n"), len(seen.decode()), len(seen))
            seen += zstandard.ZstdDecompressor().decompress(bytes(f.data))
        assert (r.feeds, r.chars, r.bytes) == (seen.count(b"\n"), len(seen.decode()), len(seen))
        joined = b"".join(bytes(f.data) for f in r.output)
        assert zstandard.ZstdDecompressor().stream_reader(joined, read_across_frames=True).read() == seen


def test_untouched_frames_move_as_they_are(spark):
    stored = fim.store(spark.createDataFrame([(12, LINES)], "doc_id long, text string"), frame_bytes=2_000)
    before = {bytes(f.data) for f in stored.first().frames}
    after = {bytes(f.data) for f in fim.transform(stored).first().output}
    assert len(before) > 50 and len(before - after) <= 2


def test_cut_opens_one_frame():
    body = LINES.encode()
    frames = fim.Frames(fim.framed(body, fim.packer(), 2_000), body.count(b"\n"), len(LINES), len(body))
    opened, read = [], frames.frame
    frames.frame = lambda i: opened.append(i) or read(i)
    for n in (0, 1, 17, 1_999, 4_000):
        at, chars = frames.after_units(n, 4_000)
        want = b"".join(body.splitlines(keepends=True)[:n])
        assert (at, chars) == (len(want), len(want.decode()))
    assert len(opened) == 3


def test_shares(spark):
    docs = spark.createDataFrame([(i, f"a{i}\nb\nc") for i in range(400)], "doc_id long, text string")
    stored = fim.store(docs)
    forms = {share: [r.form for r in fim.transform(stored, share=share, spm_share=25).collect()] for share in (0, 40, 100)}
    assert set(forms[0]) == {"plain"} and 200 < forms[40].count("plain") < 280 and "plain" not in forms[100]
    assert 60 < forms[100].count("spm") < 140


def test_other_markers_and_string_keys(spark):
    docs = spark.createDataFrame([("k1", "a\nb\n<P>"), (None, "x\ny")], "id string, body string")
    marks = ("[[pre]]", "[[suf]]", "[[mid]]")
    got = fim.texts(fim.transform(fim.store(docs, key="id", text="body", markers=marks), key="id", markers=marks), markers=marks).collect()
    assert sorted((r.restored_text, "[[mid]]" in r.output_text, r.id) for r in got) == [("a\nb\n<P>", True, "k1"), ("x\ny", True, None)]
    assert hashlib.sha256(b"7:k1").digest()[:4] == fim.draws("k1", 7)[0].to_bytes(4, "big")


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert fim.digests(fim.transform(fim.store(docs))).count() == 0 and fim.texts(fim.transform(fim.store(docs))).count() == 0
