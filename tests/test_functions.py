import hashlib
import io
import random
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.functions.alignment import diff_ops, stable_rank, word_diff
from quillon.functions.audio import decode_audio, decode_wav, log_confidence, mono, pad_samples
from quillon.functions.matching import match_callsign, partial_ratio
from quillon.functions.text import canonical_callsigns, expand_callsign, normalize, present_tails, similarity, spoken_realizations, token_distance
from quillon.functions.voting import align, rover, vote


def one(spark, row, schema, column):
    return spark.createDataFrame([row], schema).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("text", "want"),
    [("Turn left, heading 250.", "turn left heading two five zero"), ("turn left heading two five zero", "turn left heading two five zero"), ("don't  STOP!", "dont stop"), ("", ""), ("Élan ñ", "élan ñ"), (None, None)],
)
def test_normalize(spark, text, want):
    assert one(spark, (text,), "t string", normalize(F.col("t"))) == want


@pytest.mark.parametrize(
    ("tail", "want"),
    [("N172SP", "november one seven two sierra papa"), ("DAL1234", "delta one two three four"), ("4996", "four nine nine six"), ("", None), ("N-1", None), (None, None)],
)
def test_expand_callsign(spark, tail, want):
    assert one(spark, (tail,), "t string", expand_callsign(F.col("t"))) == want


def test_realizations_and_canonical(spark):
    assert one(spark, ("N172SP",), "t string", spoken_realizations(F.col("t"))) == ["november one seven two sierra papa", "one seven two sierra papa"]
    tails = (["N1", None, "", "N1", "?"],)
    assert one(spark, tails, "t array<string>", canonical_callsigns(F.col("t"))) == ["november one"]
    assert one(spark, tails, "t array<string>", present_tails(F.col("t"))) == ["N1", "N1", "?"]
    assert one(spark, (None,), "t array<string>", present_tails(F.col("t"))) == []


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def test_token_distance_and_similarity(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(40)]
    pairs = [([rng.choice(words) for _ in range(rng.randrange(30))], [rng.choice(words) for _ in range(rng.randrange(30))]) for _ in range(200)]
    got = spark.createDataFrame(pairs, "a array<string>, b array<string>").select("a", "b", token_distance(F.col("a"), F.col("b")).alias("d")).collect()
    assert all(r["d"] == edits(r["a"], r["b"]) for r in got)
    for a, b, want in (("", "", 1.0), ("cleared to land", "Cleared to land.", 1.0), ("a b c d", "a b", 0.5), (None, "x", 0.0)):
        assert one(spark, (a, b), "a string, b string", similarity(F.col("a"), F.col("b"))) == want


@pytest.mark.parametrize(
    ("texts", "weights", "text", "share"),
    [
        (["a", "a", "b"], [1, 1, 2], "a", 0.5), (["a", "a", "a z"], [1, 1, 2], "a z", 0.75), (["taxi bravo", "taxi to bravo"], [1, 1], "taxi to bravo", 2.5 / 3),
        (["", "a", ""], [1, 1, 1], "", 2 / 3), (["x", "x", "x y", "x y"], [1] * 4, "x y", 0.75), (["", "", ""], [1] * 3, "", 1.0), ([], [], "", 1.0),
    ],
)
def test_vote_vectors(texts, weights, text, share):
    got = vote([t.split() for t in texts], weights)
    assert got[0] == text and got[1] == pytest.approx(share)


def test_alignment_is_least_and_whole():
    rng = random.Random(2)
    for _ in range(300):
        a = [rng.choice(["a", "b", "c", None]) for _ in range(rng.randrange(8))]
        b = [rng.choice("abc") for _ in range(rng.randrange(8))]
        pairs = align(a, b)
        assert [i for i, _ in pairs if i is not None] == list(range(len(a))) and [j for _, j in pairs if j is not None] == list(range(len(b)))
        cost = sum(1 if None in p else int(a[p[0]] != b[p[1]]) for p in pairs)
        assert cost == edits(a, b)


def test_rover_column(spark):
    rows = [(["Turn left 250", "turn left two five zero", "turn right two five zero"], None), ([], None), (None, None), ([None, "x"], [1.0, 3.0])]
    got = [tuple(r["v"]) for r in spark.createDataFrame(rows, "t array<string>, w array<double>").select(rover(F.col("t"), F.col("w")).alias("v")).collect()]
    assert got[0][0] == "turn left two five zero" and got[1] == got[2] == ("", 1.0) and got[3][0] == "x"


def slow_ratio(a, b):
    def common(x, y):
        row = [0] * (len(y) + 1)
        for p in x:
            last = 0
            for j, q in enumerate(y, 1):
                last, row[j] = row[j], last + 1 if p == q else max(row[j], row[j - 1])
        return row[-1]

    short, long_ = sorted((a, b), key=len)
    m, n = len(short), len(long_)
    spans = [long_[max(0, k) : min(n, k + m)] for k in range(1 - m, n)]
    if m == n:
        return max([2 * common(short, s) / (m + len(s)) for s in spans] + [2 * common(long_, s) / (m + len(s)) for s in [short[max(0, k) : k + m] for k in range(1 - m, m)]])
    return max(2 * common(short, s) / (m + len(s)) for s in spans)


def test_partial_ratio_against_plain_model():
    rng = random.Random(3)
    for _ in range(200):
        a, b = ("".join(rng.choice("ab ") for _ in range(rng.randrange(1, 9))) for _ in range(2))
        assert partial_ratio(a, b)[0] == pytest.approx(slow_ratio(a, b))


def test_match_callsign(spark):
    cases = [
        ("november one seven two sierra papa cleared to land", ["N172SP"], True, False), ("november one seven two sierra hotel descend", ["N172SP"], True, True),
        ("wind calm", ["N172SP"], False, False), ("wind calm", [], False, False), (None, None, False, False), ("delta four nine nine six taxi", ["4996"], True, False),
    ]
    df = spark.createDataFrame([(t, x) for t, x, _, _ in cases], "t string, x array<string>")
    got = [r["m"] for r in df.select(match_callsign(F.col("t"), F.col("x")).alias("m")).collect()]
    assert [(m["matched"], m["snapped"]) for m in got] == [(a, b) for _, _, a, b in cases]
    assert "november one seven two sierra papa" in got[1]["text"] and got[1]["tail"] == "N172SP" and got[3]["tail"] is None
    whole = df.select(match_callsign(F.col("t"), F.col("x"), whole_words=True).alias("m")).collect()[1]["m"]["text"]
    assert "papahotel" not in whole


def test_word_diff_rebuilds_both_sides(spark):
    rng = random.Random(4)
    for _ in range(300):
        a, b = (" ".join(rng.choice("abc") for _ in range(rng.randrange(7))) for _ in range(2))
        cells = word_diff(a, b)
        assert [c["token"] for c in cells if c["op"] != "del"] == b.split()
        assert sum(c["op"] == "equal" for c in cells) <= len(a.split())
    assert [tuple(x) for x in one(spark, ("a b c", "a x"), "a string, b string", diff_ops(F.col("a"), F.col("b")))] == [("equal", "a"), ("sub", "x"), ("del", "c")]


def test_stable_rank(spark):
    ids = ["kagc/1", "kagc/2", "", None]
    got = [r["x"] for r in spark.createDataFrame([(i,) for i in ids], "i string").select(stable_rank(F.col("i")).alias("x")).collect()]
    assert [bytes(g) if g is not None else None for g in got] == [None if i is None else hashlib.blake2b(i.encode(), digest_size=8).digest() for i in ids]


def wav(samples, rate=8000, channels=1):
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(channels)
        f.setsampwidth(2)
        f.setframerate(rate)
        f.writeframes((np.asarray(samples) * 32767).astype("<i2").tobytes())
    return out.getvalue()


def test_audio(spark):
    x, rate = decode_wav(wav([0.5, -0.5, 0.5, 0.5], channels=2))
    assert rate == 8000 and np.allclose(x, [0.0, 0.5], atol=1e-3)
    got = one(spark, (bytearray(wav([0.1] * 800)),), "b binary", decode_audio(F.col("b"), 16_000, 2000))
    assert got["rate"] == 16_000 and len(got["samples"]) == 2000 and got["samples"][-1] == 0.0
    assert one(spark, (None,), "b binary", decode_audio(F.col("b"))) is None
    assert one(spark, ([[1.0, 3.0], [3.0, 5.0]],), "c array<array<float>>", mono(F.col("c"))) == [2.0, 4.0]
    assert len(one(spark, ([1.0],), "s array<float>", pad_samples(F.col("s"), 5))) == 5
    assert one(spark, ([-1.0, -3.0],), "p array<double>", log_confidence(F.col("p"))) == pytest.approx(np.exp(-2.0))
    assert one(spark, ([],), "p array<double>", log_confidence(F.col("p"))) is None
