"""Engine operators against small expected results and brute force."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from cantora.functions import fuzzy, numbers_vi, text
from cantora.operators import joins, match, order, quality, span
from cantora.plans import queries

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def values(spark, expr, rows):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, x string")
    return [r["y"] for r in df.select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()]


def test_numbers(spark):
    df = spark.createDataFrame([(i, n) for i, n in enumerate([0, 10, 15, 21, 24, 100, 105, 120, 1005, 1000000])], "i int, n long")
    got = [r["y"] for r in df.select("i", numbers_vi.spell(F.col("n")).alias("y")).orderBy("i").collect()]
    assert got == ["", "mười", "mười lăm", "hai mươi mốt", "hai mươi tư", "một trăm", "một trăm lẻ năm", "một trăm hai mươi", "một nghìn không trăm năm", "một không không không không không không"]


def test_cleaning(spark):
    got = values(spark, numbers_vi.clean_text, ["Tôi có 3.5 điểm", "17ảy", "20㎡", "2 ca 3 ca", None, "1.120", "a 99% b"])
    assert got == ["tôi có ba mươi lăm điểm", "", "hai mươi mét vuông", "song ca tam ca", "", "mộtmột hai không", "a chín mươi chín phần trăm b"]


def test_captions(spark):
    got = values(spark, text.parse_caption, ["0:044 giây xin chào", "1:02:033 giờ, 1 phút chào", "﻿0:05 hi", "no time", "0:07 44 giây"])
    assert [None if r is None else tuple(r) for r in got] == [("00:00:04", "xin chào"), ("01:02:03", "chào"), ("00:00:05", "hi"), None, None]


def test_capitals_and_spacing(spark):
    assert values(spark, text.restore_capitals, ["a. b", "hi! ? yo"]) == ["A.B", "Hi!Yo"]
    assert values(spark, text.fix_spacing, [" a  , b ! "]) == ["a, b!"]
    df = spark.createDataFrame([("one two thr%ee four five six seven",)], "x string")
    assert df.select(text.context_of(F.col("x"), text.odd_character(F.col("x"))).alias("y")).first()["y"] == "one two thr%ee four five six"


def test_similarity_forms_agree(spark):
    rng = random.Random(4)
    rows = [("".join(rng.choice("ab c") for _ in range(rng.randint(0, 9))).strip(), "".join(rng.choice("ab c") for _ in range(rng.randint(0, 9))).strip()) for _ in range(60)] + [("kitten", "sitting")]
    df = spark.createDataFrame(rows, "a string, b string")
    for r in df.select("a", "b", fuzzy.ratio(F.col("a"), F.col("b")).alias("x"), fuzzy.ratio_udf("a", "b").alias("y"), fuzzy.token_set_ratio(F.col("a"), F.col("b")).alias("u"), fuzzy.token_set_ratio_udf("a", "b").alias("v")).collect():
        assert r["x"] == pytest.approx(r["y"]) and r["u"] == pytest.approx(r["v"]), r
    assert fuzzy.lcs_length("kitten", "sitting") == 4


def test_asof_follows_the_running_maximum(spark):
    rng = random.Random(5)
    caps = [(k, i, float(rng.randint(0, 50))) for k in (1, 2) for i in range(30)]
    probes = [(k, n, float(rng.randint(0, 60))) for k in (1, 2, 3) for n in range(40)]
    got = joins.asof_previous(spark.createDataFrame(probes, "k int, n int, s double"), spark.createDataFrame(caps, "k int, idx int, start double"), "k", "s", "start", "idx", 1.0, "c", bucket=7.0)
    for r in got.collect():
        last = None
        for k, i, start in caps:
            if k == r["k"]:
                if not start < r["s"] - 1.0:
                    break
                last = i
        assert r["c"] == last, r


def test_contained_includes_both_ends(spark):
    a = spark.createDataFrame([(1, 1.0, 2.0)], "k int, s double, e double")
    b = spark.createDataFrame([(1, x) for x in (0.99, 1.0, 1.5, 2.0, 2.01)], "k int, t double")
    assert sorted(r["t"] for r in joins.contained(a, b, "k", "s", "e", "t").collect()) == [1.0, 1.5, 2.0]
    plan = joins.contained(a, b, "k", "s", "e", "t")._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_overlap_uses_segments_once(spark):
    rng = random.Random(6)
    spans = [(1, i, float(5 * i), float(5 * i + rng.randint(1, 7))) for i in range(12)]
    segs = [(1, i, s, s + rng.choice([0.0, 1.0, 4.0])) for i, s in enumerate(sorted(rng.uniform(0, 60) for _ in range(40)))]
    got = {r["seg"]: r["span"] for r in joins.overlap_first(spark.createDataFrame(spans, "k int, span int, vs double, ve double"), spark.createDataFrame(segs, "k int, seg int, s double, e double"), "k", bucket=9.0).collect()}
    used = {}
    for _, v, vs, ve in spans:
        for _, i, s, e in segs:
            if i not in used and max(0, min(ve, e) - max(vs, s)) > 0:
                used[i] = v
    assert got == used


def test_structure(spark):
    def slow(w, c):
        return bool(w and c) and (w == c or any(w[:i] + [sum(w[i:j])] + w[j:] == c for i in range(len(w)) for j in range(i + 2, len(w) + 1)))

    rng = random.Random(7)
    rows = [([rng.randint(1, 3) for _ in range(rng.randint(0, 5))], [rng.randint(1, 5) for _ in range(rng.randint(0, 4))]) for _ in range(400)]
    df = spark.createDataFrame(rows, "a array<int>, b array<int>")
    for r in df.select("a", "b", match.structure_pass(F.col("a"), F.col("b")).alias("y")).collect():
        assert r["y"] == slow(list(r["a"]), list(r["b"])), r


def test_best_substring_forms_agree(spark):
    rng = random.Random(8)
    word = lambda: rng.choice(["xin", "chào", "các", "bạn.", "hôm", "nay!", "là"])
    rows = [(i, " ".join(word() for _ in range(rng.randint(1, 6))), " ".join(word() for _ in range(rng.randint(0, 9)))) for i in range(25)]
    df = spark.createDataFrame(rows, "i int, w string, c string")
    want = {r["i"]: (r["candidate"], r["score"]) for r in match.best_substring_relational(df, "i", "w", "c").collect()}
    for r in df.select("i", match.best_substring("w", "c").alias("m")).collect():
        t, s = want.get(r["i"], ("", match.NO_MATCH))
        assert r["m"]["matched_text"] == t and r["m"]["score"] == pytest.approx(s)


NAMES = [n for n, _ in span.FIELDS]


def test_best_span():
    w = ["à", "một", "hai", "ba", "bốn", "x"]
    starts, ends, odds = [0.4 * i for i in range(6)], [0.4 * i + 0.3 for i in range(6)], [0.5, None, 1.0, 0.5, 0.5, None]
    got = dict(zip(NAMES, span.search("một hai ba bốn", w, starts, ends, odds, 0.4, 1.9)))
    assert got["matched_text"] == "một hai ba bốn" and got["score"] == 100.0 and (got["word_start_index"], got["word_end_index"]) == (1, 4)
    assert got["avg_word_probability"] == 0.6667 and got["max_word_gap"] == 0.1 and got["reason"] is None
    why = lambda *a: span.search(*a)[-1]
    assert why("", w, starts, ends, odds, 0, 1) == "EMPTY_EXPECTED_TEXT" and why("17ảy", w, starts, ends, odds, 0, 1) == "EMPTY_EXPECTED_TEXT"
    assert why("a", [], [], [], [], 0, 1) == "NO_WORDS" and why("a", w, starts, ends, odds, None, 1) == "BAD_EXPECTED_TIME" and why("a", w, starts, ends, odds, 1, 1) == "BAD_EXPECTED_DURATION"
    assert why("zzz", w, starts, ends, odds, 0.0, 0.4).startswith("NO_GOOD_SPAN|FIRST_WORD_REJECT=")
    assert span.search("ba", ["3"], [0.0], [0.4], [None], 0.0, 0.4)[1] == 100.0
    assert span.search("song ca", ["2", "ca"], [0.0, 0.5], [0.4, 0.9], [], 0.0, 0.9)[1] == 100.0


def plain_span(text, found, s, e, start, end, how):
    """The search as nested loops over joined texts."""
    normal = span.expected_words if how.cleaned else span.spoken
    target, best, refused = normal(text), None, dict.fromkeys(("FIRST_WORD", "LAST_WORD", "TIME", "DURATION"), 0)
    for skip in range(min(how.skips, len(target) - 1) + 1):
        core = target[skip:]
        for i in range(len(found)):
            for j in range(i + max(1, int(len(core) * 0.75)), min(len(found), i + max(1, int(len(core) * 1.25))) + 1):
                at = i - skip
                if at < 0:
                    continue
                length = e[j - 1] - s[at]
                words = normal(" ".join(found[i:j]))
                first, last = (fuzzy.ratio_of(core[0], words[0]), fuzzy.ratio_of(core[-1], words[-1])) if words else (0, 0)
                if s[at] < max(0.0, start - 1.0) or e[j - 1] > end + 1.0:
                    refused["TIME"] += 1
                elif length < (end - start) * 0.70 or length > (end - start) * 1.30:
                    refused["DURATION"] += 1
                elif how.first is not None and first < how.first:
                    refused["FIRST_WORD"] += 1
                elif how.last is not None and last < how.last:
                    refused["LAST_WORD"] += 1
                else:
                    score = fuzzy.ratio_of(" ".join(target), " ".join(normal(" ".join(found[at:j]))))
                    score -= abs(s[at] - start) * 10 + abs(e[j - 1] - end) * 10 + abs(length - (end - start)) * 8 + skip * 3 + how.penalty * ((first < how.dear) + (last < how.dear))
                    if best is None or score > best[0]:
                        best = (round(score, 2), skip, at, i, j - 1)
    return best, "NO_GOOD_SPAN" + "".join(f"|{k}_REJECT={v}" for k, v in refused.items()) * how.counted


@pytest.mark.parametrize("how", [span.CURRENT, span.OLDER, span.ALIGNED])
def test_span_search_equals_nested_loops(how):
    rng, hits = random.Random(21), 0
    for _ in range(250):
        words = [rng.choice(["một", "hai", "ba", "ba.", "—", "bốn", "3", "1.120", "2", "ca", "tôn", "hùng", "99%", "a-b", "17ảy" if rng.random() < 0.1 else "x"]) for _ in range(rng.randint(1, 9))]
        s = [0.4 * i + rng.choice([0, 0.05]) for i in range(len(words))]
        e = [x + rng.choice([0.2, 0.3]) for x in s]
        a = rng.randrange(len(words))
        b = rng.randint(a + 1, len(words))
        text = " ".join(rng.choice(words) if rng.random() < 0.2 else w for w in words[a:b])
        start, end = s[a] + rng.choice([0, 0.1]), e[b - 1]
        if end <= start or not (span.expected_words if how.cleaned else span.spoken)(text):
            continue
        got = dict(zip(NAMES, span.search(text, words, s, e, [], start, end, how)))
        best, why = plain_span(text, words, s, e, start, end, how)
        if best is None:
            assert got["reason"] == why, (text, words)
        else:
            hits += 1
            assert (got["score"], got["prefix_skip"], got["word_start_index"], got["word_core_start_index"], got["word_end_index"]) == pytest.approx(best), (text, words)
    assert hits > 60


def test_cleaning_forms_agree(spark):
    rng = random.Random(22)
    texts = [" ".join(rng.choice(["2", "ca", "3", "120", "1.120", "007", "1000000", "5,b", "20㎡", "m²", "99%", "tôn", "hùng", "Ba", "x-1", "0", "12,", "21", "1005"]) for _ in range(rng.randint(0, 6))) for _ in range(200)]
    assert values(spark, numbers_vi.clean_text, texts) == [numbers_vi.clean_text_of(t) for t in texts]
    assert values(spark, text.expected_form, texts) == [" ".join(span.expected_words(t)) for t in texts]


def test_half_even(spark):
    rng = random.Random(23)
    numbers = [2.675, 1.005, 0.125, 0.375, 2.5, -2.5, -0.125, -2.675, 0.0, 1e6 + 0.5, 85.85, 104.0] + [rng.uniform(-1000, 1000) for _ in range(500)] + [k / 8 for k in range(-50, 50)] + [k / 1000 for k in range(5, 4000, 10)]
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    for places in (0, 1, 2, 3, 4):
        assert [r["y"] for r in df.select(text.round_half_even(F.col("x"), places).alias("y")).collect()] == [float(round(x, places)) for x in numbers]


def test_substring_versions():
    assert match.search_substring("xin chào các bạn", "xin chào các bạn. hôm nay", how=match.SECOND) == ("xin chào các bạn.", 105.0)
    assert match.search_substring("một", "hai ba", how=match.FIRST) == ("hai ba", 0.0) and match.search_substring("một", "hai ba", how=match.SECOND) == ("", match.NO_MATCH)


ODD_CAPITALS = ["ßa. ßb", "x. ŉb! ᾳ?ﬁn", "über. ǆx. ß", "ß", None, "", ". ß", "ΐ. և. ẖ", "😀. é"]


def odd_documents(tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"doc_id": pa.array(range(len(ODD_CAPITALS)), pa.int64()), "text": ODD_CAPITALS}), tmp_path / "documents.parquet")
    return str(tmp_path)


def as_sql(spark, name, sf, *tables):
    """The query's rows, which must be those of its SQL."""
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    got = sorted(tuple(r) for r in queries.QUERIES[name](spark, sf).collect())
    assert got == sorted(con.execute(queries.SQL[name]).fetchall())
    return got


def test_clean_spoken_capitals(spark, tmp_path):
    got = dict(as_sql(spark, "clean_spoken", odd_documents(tmp_path), "documents"))
    assert got[0] == "ẞa.ẞb" and got[3] == "ẞ" and got[4] is None


def test_restore_caps_capitals(spark, tmp_path):
    got = dict(as_sql(spark, "restore_caps", odd_documents(tmp_path), "documents"))
    assert got[1] == "X.ŉb!ᾼ?ﬁn" and got[2] == "Über.Ǆx.ẞ" and got[7] == "ΐ.և.ẖ"


def test_restore_caps_of_every_character(spark, tmp_path):
    """White space beyond ASCII stays at the ends of sentences, and the letters whose capital is of Unicode 16 stay small, as in the SQL."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    points = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    rng = random.Random(28)
    texts = ["\xa0a\u3000. \u2003b", "\x0ba\x1f.\tb\f!\x85", "ɤa. ƛ\u2028", "a \u2029.\r\n𐵰b \x85"] + [".".join(f" {c}a{c} " for c in points[i : i + 4096]) for i in range(0, len(points), 4096)]
    texts += ["".join(rng.choice(" \t\n\v\f\r\x1c\x85\xa0\u2028\u0301.!?aßŉɤᲊé한😀") for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    pq.write_table(pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": texts}), tmp_path / "documents.parquet")
    got = dict(as_sql(spark, "restore_caps", str(tmp_path), "documents"))
    assert [got[i] for i in range(4)] == ["\xa0a\u3000.\u2003b", "\x0ba\x1f.B!\x85", "ɤa.ƛ\u2028", "A \u2029.𐵰b \x85"]
    assert values(spark, text.restore_capitals, texts[:1]) == ["A.B"]  # by itself, Python's white space


def test_part_order_counts_repeated_names(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    ids = [None, -3, -5, *range(0, 40), *range(990, 1050), *range(2000, 2040)]
    pq.write_table(pa.table({"page_id": pa.array(ids, pa.int64())}), tmp_path / "pages.parquet")
    got = as_sql(spark, "part_order", str(tmp_path), "pages")
    assert len(got) < max(position for _, position in got)  # the names of 1 and 1001 are alike
    files = [f"{random.Random(27).choice('ab')}{i % 90}_{i % 13}.json" for i in range(200)]
    table = spark.createDataFrame([(f, i) for i, f in enumerate(files)], "f string, i int")
    ranked = sorted(range(200), key=lambda i: (i % 13, files[i]))
    for prefix in (1, 3, 20):
        numbered = order.number_files(table, "f", "n", prefix).collect()
        assert [r["f"] for r in sorted(numbered, key=lambda r: r["n"])] == [files[i] for i in ranked]


def test_greedy_overlap_takes_the_best_unused(spark):
    rng = random.Random(24)
    for least in (0.0, 0.3):
        spans = [(k, i, s, s + rng.choice([0.0, 1.0, 3.0])) for k in (1, 2) for i, s in enumerate(sorted(rng.uniform(0, 40) for _ in range(15)))]
        segs = [(k, i, s, s + rng.choice([0.0, 0.2, 2.0, 6.0])) for k in (1, 2, 3) for i, s in enumerate(rng.uniform(0, 40) for _ in range(25))]
        want, used = set(), set()
        for k, v, vs, ve in spans:
            best, best_seg = 0.0, None
            for k2, i, s, e in segs:
                o = max(0.0, min(ve, e) - max(vs, s))
                if k2 == k and (k, i) not in used and o > best:
                    best, best_seg = o, i
            if best_seg is not None and best >= least:
                used.add((k, best_seg))
                want.add((k, v, best_seg))
        got = joins.greedy_overlap(spark.createDataFrame(spans, "k int, span long, vs double, ve double"), spark.createDataFrame(segs, "k int, seg long, s double, e double"), "k", least)
        assert {tuple(r) for r in got.collect()} == want


def test_greedy_overlap_streams_large_ids_and_long_pieces(spark):
    rng, big = random.Random(26), 1 << 60
    spans = [(k, big + 2 * i + 1, s, s + rng.choice([1.0, 30.0])) for k in (None, 1, 2) for i, s in enumerate(sorted(float(rng.randrange(400)) for _ in range(60)))]
    segs = [(k, big + 2 * i + 1, s, s + rng.choice([1.0, 2.0, 60.0])) for k in (None, 2, 3) for i, s in enumerate(float(rng.randrange(400)) for _ in range(700))]
    segs += [(2, 1, 0.0, 500.0), (2, 3, None, 9.0), (2, 5, 9.0, None), (1, 7, 5.0, 5.0)]
    want, used = set(), set()
    for k, v, vs, ve in spans:
        best, best_seg = 0.0, None
        for k2, i, s, e in sorted((x for x in segs if None not in x[2:]), key=lambda x: x[1]):
            o = min(ve, e) - max(vs, s)
            if k2 == k and (k, i) not in used and o > best:
                best, best_seg = o, i
        if best_seg is not None:
            used.add((k, best_seg))
            want.add((k, v, best_seg))
    got = joins.greedy_overlap(spark.createDataFrame(spans, "k int, span long, vs double, ve double"), spark.createDataFrame(segs, "k int, seg long, s double, e double"), "k")
    assert len(want) > 100
    for rows in ("10000", "7"):  # pieces that reach over batches
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
        try:
            assert {tuple(r) for r in got.collect()} == want
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert "InPandas" not in got._jdf.queryExecution().toString()  # a group for each piece takes a thousandth of a second each


def test_sparse_positions(spark):
    rng = random.Random(25)
    ids = [*{rng.randrange(-(1 << 62), 1 << 62) for _ in range(3000)}]
    df = spark.createDataFrame([(i, i % 2) for i in ids], "i long, k long")
    assert {r["i"]: r["n"] for r in order.number_rows(df, "i", "n", chunk=100).collect()} == {i: n for n, i in enumerate(sorted(ids))}
    parts = order.chunked(df, "i", "c", chunk=100).groupBy("c").count().collect()
    assert len(parts) >= 25 and max(r["count"] for r in parts) < 400
    rows = [(k, i, rng.random()) for k in (0, 1) for i in sorted(x for x in ids if x % 2 == k)]
    got = {r["i"]: r["m"] for r in joins.running_max(spark.createDataFrame(rows, "k long, i long, v double"), "k", "i", "v", "m", chunk=50).collect()}
    for k in (0, 1):
        top = -1.0
        for _, i, v in (r for r in rows if r[0] == k):
            top = max(top, v)
            assert got[i] == top
    ends = order.trim_ends(spark.createDataFrame([("a", 0, 1), ("a", 0, 2), ("a", 1, 3), ("a", 2, 4), ("b", 0, 1), ("b", 1, 2)], "f string, pos int, x int"), "f", "pos")
    assert sorted((r["f"], r["pos"]) for r in ends.collect()) == [("a", 0), ("a", 1)]


def test_floor_division(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 1200.015, 3600.045, 5000.0)], "x double")
    assert [r["y"] for r in df.select(quality.floor_div(F.col("x"), 1200.015).alias("y")).collect()] == [int(x // 1200.015) for x in (0.0, 1200.015, 3600.045, 5000.0)]


def test_numbering_in_chunks(spark):
    df = spark.createDataFrame([(i,) for i in range(0, 1000, 7)], "i long")
    assert {r["i"]: r["n"] for r in order.number_rows(df, "i", "n", chunk=50).collect()} == {i: k for k, i in enumerate(range(0, 1000, 7))}


def rounded(v):
    return round(float(v), 4) if isinstance(v, float) else tuple(map(rounded, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = queries.QUERIES[name](spark, DATA)
    rel = c.sql(queries.SQL[name])
    columns = sorted(rel.columns)
    assert columns == sorted(df.columns)
    want = sorted(repr(tuple(map(rounded, r))) for r in rel.select(", ".join(f'"{x}"' for x in columns)).fetchall())
    assert sorted(repr(tuple(rounded(r[x]) for x in columns)) for r in df.collect()) == want
