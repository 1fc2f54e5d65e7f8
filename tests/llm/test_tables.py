"""Timestamps, whitening, decontamination: against plain Python."""

import random
import re
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillstone.llm import decontamination as D
from quillstone.llm import timestamps as T
from quillstone.llm import whitening as W

from .helpers import AWKWARD, DOCS, docs, low

# 11: timestamps

STAMP = re.compile(
    r"(?:(?P<y1>20\d\d)-(?P<m1>\d\d)-(?P<d1>\d\d)|(?P<y2>20\d\d)(?P<m2>\d\d)(?P<d2>\d\d)|(?P<d3>\d\d)[.](?P<m3>\d\d)[.](?P<y3>20\d\d)|(?P<d4>\d\d) (?P<m4>" + "|".join(T.MONTHS) + r") (?P<y4>20\d\d)|(?P<p>\d\d)/(?P<q>\d\d)/(?P<y5>20\d\d))"
    r"(?:[T ](?P<h>\d\d):(?P<mi>\d\d)(?::(?P<s>\d\d))?(?: ?(?P<half>[AP]M))?(?: ?(?P<off>Z|[+-]\d\d:?\d\d))?)?",
    re.ASCII,
)


def plainly(raw, zone):
    """(kind, possible local times or instants by order, offset) of one text."""
    r = (raw or "").strip(T.SPACES)
    if re.fullmatch(r"[0-9]{10}|[0-9]{13}", r):
        return [int(r) * (1_000_000 if len(r) == 10 else 1000)], None
    if not (m := STAMP.fullmatch(r)):
        return [], None
    g = m.groupdict()
    hour, minute, second = int(g["h"] or 0), int(g["mi"] or 0), int(g["s"] or 0)
    if g["half"]:
        if not 1 <= hour <= 12:
            return [], None
        hour = hour % 12 + 12 * (g["half"] == "PM")
    y = int(next(g[x] for x in ("y1", "y2", "y3", "y4", "y5") if g[x]))
    if g["p"]:
        orders = [(int(g["p"]), int(g["q"])), (int(g["q"]), int(g["p"]))]
    else:
        k = next(x for x in "1234" if g[f"y{x}"])
        orders = [(T.MONTHS.index(g["m4"]) + 1 if k == "4" else int(g[f"m{k}"]), int(g[f"d{k}"]))]
    out = []
    for month, day in orders:
        try:
            wall = datetime(y, month, day, hour, minute, second)
        except ValueError:
            out.append(None)
            continue
        if g["off"]:
            sign, rest = g["off"][0], g["off"][1:].replace(":", "")
            if rest and (int(rest[:2]) > 14 or int(rest[2:]) > 59):
                return [], None
            shift = timedelta(hours=int(rest[:2] or 0), minutes=int(rest[2:] or 0)) * (-1 if sign == "-" else 1) if rest else timedelta(0)
            at, odd = (wall - shift).replace(tzinfo=timezone.utc), False
        else:
            try:
                local = wall.replace(tzinfo=ZoneInfo(zone))
            except Exception:  # noqa: BLE001
                return [], None
            at, odd = local.astimezone(timezone.utc), local.utcoffset() != local.replace(fold=1).utcoffset()
        out.append((int((at - datetime(1970, 1, 1, tzinfo=timezone.utc)).total_seconds()) * 1_000_000, odd, wall.date()))
    return out, bool(g["p"])


def expected(rows):
    read = [plainly(raw, zone) for _, _, zone, raw in rows]
    votes = {}
    for (_, source, _, _), (found, slashed) in zip(rows, read):
        if slashed and found and (found[0] is None) != (found[1] is None):
            votes.setdefault(source, [0, 0])[found[0] is None] += 1
    out = []
    for (i, source, _, _), (found, slashed) in zip(rows, read):
        real = [x for x in found if x is not None]
        if not real:
            out.append((i, None, "bad", False))
        elif not isinstance(real[0], tuple):
            out.append((i, real[0], "plain", False))
        elif slashed and len(real) == 2 and real[0][2] != real[1][2]:
            month, day = votes.get(source, [0, 0])
            rule = "votes" if day > 3 * month or month > 3 * day else "default"
            out.append((i, real[day > 3 * month][0], rule, True))
        else:
            out.append((i, real[0][0], "plain", real[0][1]))
    return sorted(out, key=repr)


STAMPS = "stamp_id long, source string, zone string, raw string, key string, salt string, kind string, utc string, id string"
ZONES = ["UTC", "Europe/Berlin", "America/New_York", "Asia/Kolkata", "Australia/Lord_Howe", "Africa/Casablanca", None, "No/Where", ""]


def stamps(spark, rows):
    return spark.createDataFrame([(*r, "k", "s", "x", "u", "i") for r in rows], STAMPS)


def read(df):
    return sorted(((r.stamp_id, r.utc_us, r.rule, r.ambiguous) for r in df.collect()), key=repr)


def test_stamps_by_hand(spark):
    at = lambda *x: int(datetime(*x, tzinfo=timezone.utc).timestamp()) * 1_000_000
    cases = [
        (" 1733025832\t", "UTC", at(2024, 12, 1, 4, 3, 52), False), ("1733942329007", "UTC", 1733942329007000, False), ("0000000000", None, 0, False),
        ("2024-03-31 02:30", "Europe/Berlin", at(2024, 3, 31, 1, 30), True), ("2024-10-27 02:30", "Europe/Berlin", at(2024, 10, 27, 0, 30), True), ("2024-10-27 03:00", "Europe/Berlin", at(2024, 10, 27, 2), False),
        ("2024-03-31 03:00", "Europe/Berlin", at(2024, 3, 31, 1), False), ("2024-03-31 01:59:59", "Europe/Berlin", at(2024, 3, 31, 0, 59, 59), False),
        ("05 Nov 2024 12:48 AM", "UTC", at(2024, 11, 5, 0, 48), False), ("05 Nov 2024T12:48PM+14:59", "UTC", at(2024, 11, 4, 21, 49), False), ("20240229", "Asia/Kolkata", at(2024, 2, 28, 18, 30), False),
        ("26.01.2024 17:55:06 -0130", None, at(2024, 1, 26, 19, 25, 6), False), ("2024-01-26 17:55Z", "No/Where", at(2024, 1, 26, 17, 55), False), ("07/07/2024", "UTC", at(2024, 7, 7), False), ("07/31/2024", "UTC", at(2024, 7, 31), False),
    ]
    bad = ["", None, " ", "n/a", "2024-02-30", "20230229", "2024-01-01 24:00", "2024-01-01 10:60", "2024-01-01 10:10:60", "2024-01-01 13:00 PM", "2024-01-01 00:30AM", "2024-01-01 10:00+15:00", "2024-01-01 10:00+10:60", "1999-01-01", "2100-01-01", "31/02/2024", "2024-01-01Z", "2024-01-01  10:00", "2024-01-01T", "01 nov 2024", "01 Nov 24", "173302583", "17330258321", "2024-01-01 10:00 pm", "１７３３０２５８３２", "2024-01-01é", "9" * 70_000, " " * 70_000]
    rows = [(k, "s", zone, raw) for k, (raw, zone, _, _) in enumerate(cases)] + [(100 + k, "s", "UTC", raw) for k, raw in enumerate(bad)] + [(200, "s", None, "2024-01-01"), (201, "s", "No/Where", "2024-01-01 10:00")]
    got = {r.stamp_id: (r.utc_us, r.rule, r.ambiguous) for r in T.normalise(stamps(spark, rows)).collect()}
    assert got == {k: (want, "plain", odd) for k, (_, _, want, odd) in enumerate(cases)} | {i: (None, "bad", False) for i, *_ in rows[len(cases) :]}


def test_stamps_against_plain_python(spark):
    rng = random.Random(5)
    two = lambda n: f"{rng.randrange(n):02d}"

    def stamp(source):
        y, m, d = f"20{two(100)}" if rng.random() < 0.2 else "2024", two(14), two(33)
        if source == "day" and rng.random() < 0.8:
            m, d = two(13), two(32)
            date = f"{d}/{m}/{y}"
        else:
            date = rng.choice([f"{y}-{m}-{d}", f"{y}{m}{d}", f"{d}.{m}.{y}", f"{d} {rng.choice(T.MONTHS)} {y}", f"{d}/{m}/{y}", f"{m}/{d}/{y}", f"{m}/{d}/{y}"])
        if rng.random() < 0.3:
            return date
        zone = rng.choice(["", "", "", "Z", " Z", f"+{two(16)}:{two(61)}", f" -{two(16)}{two(60)}"])
        return f"{date}{rng.choice('T ')}{two(25)}:{two(61)}{rng.choice(['', f':{two(61)}'])}{rng.choice(['', '', ' AM', 'PM'])}{zone}"

    sources = ["day", "tie", "few", None, "hot", "hot", "hot"]
    rows = [(k, s := rng.choice(sources), rng.choice(ZONES), stamp(s)) for k in range(4000)]
    rows += [(5000 + k, "three", "UTC", x) for k, x in enumerate(["13/01/2024"] * 3 + ["01/13/2024", "02/03/2024"])] + [(6000, "four", "UTC", x) for x in ["13/01/2024"] * 4 + ["01/13/2024", "02/03/2024", "02/03/2024"]]
    rows += [(7000 + k, "s", "Africa/Casablanca", f"2024-{m:02d}-{d:02d} 02:30") for k, (m, d) in enumerate((m, d) for m in (3, 4) for d in range(1, 31))]
    assert read(T.normalise(stamps(spark, rows))) == expected(rows)


def test_stamps_empty_and_null_source(spark):
    assert T.normalise(stamps(spark, [])).count() == 0
    rows = [(None, None, "UTC", "13/01/2024"), (None, None, "UTC", "02/03/2024"), (1, "", "UTC", "02/03/2024")]
    assert read(T.normalise(stamps(spark, rows))) == expected(rows)


def test_query_names_epochs(spark, tmp_path):
    rows = [(1, "s", "UTC", " 1733025832"), (2, "s", None, "1733942329007"), (3, "s", "UTC", "2024-07-07"), (4, "s", "UTC", "02/03/2024"), (5, "s", "UTC", "173302583"), (6, "t", "UTC", "31/01/2024"), (7, "t", "UTC", "02/03/2024")]
    stamps(spark, rows).write.parquet(f"{tmp_path}/stamps.parquet")
    found = T.op11_timestamps(spark, str(tmp_path))
    assert found.columns == ["stamp_id", "utc_us", "rule", "ambiguous"]
    assert {r.stamp_id: (r.rule, r.ambiguous) for r in found.collect()} == {1: ("epoch", False), 2: ("epoch", False), 3: ("plain", False), 4: ("default", True), 5: ("bad", False), 6: ("plain", False), 7: ("votes", True)}


def test_hot_source_is_joined_in_parts(spark):
    rows = spark.range(20_000).select(F.col("id").alias("stamp_id"), F.when(F.col("id") % 50 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id"))).alias("source"), F.lit("UTC").alias("zone"), F.when(F.col("id") % 3 == 0, "13/02/2024").otherwise("02/03/2024").alias("raw"))
    found = T.normalise(rows)
    assert {(r.rule, r["count"]) for r in found.groupBy("rule").count().collect()} == {("plain", 6667), ("votes", 13_067), ("default", 266)}
    plan = found._sc._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "simple")
    assert "Broadcast" not in plan and "SinglePartition" not in plan


# 12: whitening

VECTORS = "vec_id long, embedding array<float>, label int, id string, x string, n string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "i", "x", "n") for i, v in rows], VECTORS)


def whole(rows):
    return [(i, [int(np.floor(256 * float(np.float32(c)))) for c in v]) for i, v in rows if v is not None and all(c is not None and np.isfinite(np.float32(c)) for c in v)]


def check_whitening(found, rows, k=4):
    x = np.array(sorted({tuple(v) for _, v in rows}), dtype=float)
    n, sums = len(x), [sum(c) for c in zip(*{tuple(v) for _, v in rows})]
    covariance = np.cov(x.T, bias=True)
    values, found_vectors = np.linalg.eigh(covariance)
    by = {}
    for r in found:
        by.setdefault(r.component, []).append(r)
    assert sorted(by) == list(range(1, k + 1))
    kept = dict(rows)
    for j, own in by.items():
        assert sorted((r.vec_id for r in own), key=str) == sorted((i for i, _ in rows), key=str)
        e, v = values[-j], found_vectors[:, -j]
        w = np.array([(np.array(kept[r.vec_id]) - x.mean(axis=0)) @ v / np.sqrt(e) for r in own])
        got = np.array([r.whitened for r in own])
        assert min(np.abs(got - w).max(), np.abs(got + w).max()) < 1e-6
        for r in own:
            assert r.n == n and r.deviation == sum((n * c - s) ** 2 for c, s in zip(kept[r.vec_id], sums))
            assert abs(r.explained / (e / covariance.trace()) - 1) < 1e-9 and r.identity_error < 1e-9


def test_whitening_against_numpy(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(400, 8)) * [5, 4, 3, 2, 1, 0.5, 0.2, 0.1]
    rows = [(k, v.tolist()) for k, v in enumerate(base)] + [(1000 + k, base[0].tolist()) for k in range(300)] + [(None, base[1].tolist()), (2000, [3.0, -200.0, 10.0, 0.0, -0.0, 0.0, 0.0, 1e-9])]
    odd = [(3000, None), (3001, [None] + [1.0] * 7), (3002, [float("nan")] * 8), (3003, [float("inf")] * 8), (3004, []), (3005, [1.0] * 3), (3006, [1e30] * 8)]
    check_whitening(W.whitening_report(vectors(spark, rows + odd)).collect(), whole(rows))
    plain = W.whiten(vectors(spark, rows + odd))
    assert plain.count() == len(rows) and {len(r.whitened) for r in plain.collect()} == {4}


def test_whitening_of_the_table(spark):
    source = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = whole([(r.vec_id, r.embedding) for r in source.collect()])
    check_whitening(W.whitening_report(source).collect(), rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_whitening_without_variation(spark, rows):
    assert W.whitening_report(vectors(spark, rows)).count() == 0 and W.whiten(vectors(spark, rows)).count() == 0


def test_whitening_in_few_directions(spark):
    rows = [(k, [float(k), 2.0 * k, 1.0]) for k in range(10)]
    assert {r.component for r in W.whitening_report(vectors(spark, rows)).collect()} == {1}


def test_packed_vectors():
    x = np.array([[0, -1], [32_767, -32_768], [1 << 31, 5], [-(1 << 40), 1 << 61]], dtype=np.int64)
    packed = W._packed(x)
    assert [len(p) for p in packed] == [5, 9, 17, 17] and (W._unpacked(pa.array(packed), 2) == x).all()


def test_deviations_are_exact():
    model = W.Whitening(3_000_000_000, [7, -9], np.eye(2), np.ones(2), 2.0)
    x = np.array([[0, 0], [1, -1], [40_000, 3]], dtype=np.int64)
    want = [sum((3_000_000_000 * int(c) - s) ** 2 for c, s in zip(r, model.sums)) for r in x]
    assert model.deviations(x) == [w if w < 1 << 63 else None for w in want] and want[2] >= 1 << 63 and model.deviations(x[:0]) == []


# 13: decontamination

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def overlaps(rows, items, n=10):
    windows = {}
    for item, text in items:
        w = WORDS.findall(low(text))
        for k in range(max(len(w) - n, 0) + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add("" if item is None else str(item))
    out = []
    for i, text in rows:
        w, hit, found = WORDS.findall(low(text)), set(), set()
        for k in range(len(w)):
            for size in {len(x) for x in windows}:
                if k + size <= len(w) and (own := windows.get(tuple(w[k : k + size]))):
                    hit |= set(range(k, k + size))
                    found |= own
        out.append((i, len(w), tuple(sorted(hit)), tuple(sorted(found))))
    return sorted(out, key=repr)


def got_overlaps(df):
    return sorted(((r.doc_id, r.n_words, tuple(k for s in sorted(r.spans) for k in range(s.first, s.end)), tuple(sorted(r["items"]))) for r in df.collect()), key=repr)


ITEMS = [(1, "the Quick brown fox jumps over the lazy dog, again and again and again"), (2, "short item"), (3, "ÉTÉ à 12 la-plage"), (4, ""), (5, None), (None, "no name for this"), (10, "short item"), (2, "short item"), (7, "aa " * 30), (8, "...")]


def benchmark(spark, items):
    return spark.createDataFrame([(i, t, "w", "x", "r") for i, t in items], "item_id long, text string, window string, item string, raw string")


def texts():
    rng = random.Random(2)
    filler = [f"w{k}" for k in range(50)] + ["aa", "short", "the", "item", "été"]
    out = []
    for k in range(120):
        words = [rng.choice(filler) for _ in range(rng.randrange(60))]
        for _, t in rng.sample(ITEMS, 2):
            part = (t or "").split()
            cut = rng.randrange(len(part) + 1) if rng.random() < 0.3 else 0
            at = rng.randrange(len(words) + 1)
            words[at:at] = part[cut:]
        out.append((k, rng.choice([" ", "\n", "--", " \x7f"]).join(words)))
    return out


@pytest.mark.parametrize("bound", [None, 5])
def test_contaminated_against_plain_python(spark, monkeypatch, bound):
    if bound:
        monkeypatch.setattr(D, "BLOCK_ROWS", bound)
    rows = texts() + AWKWARD + [(500, "aa " * 20_000), (501, "SHORT item")]
    assert got_overlaps(D.contaminated(docs(spark, rows), benchmark(spark, ITEMS))) == overlaps(rows, ITEMS)


def test_contaminated_empty(spark):
    none, some = spark.createDataFrame([], DOCS), docs(spark, AWKWARD)
    assert D.contaminated(none, benchmark(spark, ITEMS)).count() == 0
    assert got_overlaps(D.contaminated(some, benchmark(spark, []))) == overlaps(AWKWARD, [])


def test_equal_hashes_are_compared(monkeypatch):
    monkeypatch.setattr(D, "_rolled", lambda ids, n: np.zeros(len(ids) - n + 1, dtype=np.uint64))
    grams = D.NGrams([("a", b"x y"), ("b", b"y z"), ("c", b"z z")])
    hit, items = grams.hits(b"q x y q z z".split())
    assert hit.tolist() == [False, True, True, False, True, True] and items == {"a", "c"}


def test_decontaminated(spark):
    rows = [(1, "Before: SHORT -- item, after"), (2, "nothing here"), (3, None), (4, "ÉtÉ à 12 LA plage"), (5, "short item short item"), (6, "")]
    given = docs(spark, rows)
    clean = D.decontaminated(given, benchmark(spark, ITEMS))
    assert clean.columns == given.columns
    assert {r.doc_id: r.text for r in clean.collect()} == {1: "Before: , after", 2: "nothing here", 3: None, 4: "", 5: "", 6: ""}
    left = D.decontaminated(given, benchmark(spark, ITEMS), remove="documents")
    assert left.columns == given.columns and {r.doc_id for r in left.collect()} == {2, 3, 6}
    with pytest.raises(ValueError):
        D.decontaminated(given, benchmark(spark, ITEMS), remove="lines")


