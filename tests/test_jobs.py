"""Files to tables: readers, sinks, and the jobs on small synthetic files with the edge rows."""

import io
import json
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from cantora import models, schemas
from cantora.operators import quality, report, span
from cantora.plans import jobs
from cantora.sources import audio, json_files, transcripts
from cantora.streaming import incremental


def write(folder, files):
    folder.mkdir(parents=True, exist_ok=True)
    for name, content in files.items():
        (folder / name).write_text(content if isinstance(content, str) else json.dumps(content, ensure_ascii=False), encoding="utf-8")
    return str(folder)


def seg(start, end, text):
    return {"start": start, "end": end, "text": text}


@pytest.fixture
def parts(tmp_path):
    first = [seg(0, 1, "cut"), seg(10, 14, "xin chào các bạn."), seg(20, 20, "không có gì ở đây"), seg(50, 53, "một, hai ba bốn năm."), seg(100, 104, "xin chào các bạn."), seg(300, 301, "cut")]
    return write(tmp_path / "parts", {"_vid_1.json": first, "_vid_2.json": [seg(0, 1, "a"), seg(5, 9, "hôm nay trời đẹp."), seg(9, 10, "b")], "_vid_10.json": [seg(0, 1, "a"), seg(1, 2, "b")], "_vid_3.json": []})


def test_alignment_from_files(spark, tmp_path, parts):
    captions = write(tmp_path / "captions", {"vid_clean.txt": "00:00:11 xin chào các bạn.\n00:00:08 hôm qua\nno time\n00:00:11 xin chào các bạn.\n00:00:50 một hai ba bốn.\n00:01:39 quá sớm\n00:20:06 hôm nay trời đẹp.\r\n"})
    lines = transcripts.read_captions(spark, captions)
    assert [(r["job"], r["idx"], r["start"]) for r in lines.orderBy("idx").collect()] == [("vid", 0, 11), ("vid", 1, 8), ("vid", 3, 11), ("vid", 4, 50), ("vid", 5, 99), ("vid", 6, 1206)]
    segments = transcripts.read_parts(spark, parts)
    assert sorted((r["part_index"], r["source_index"], round(r["global_start"], 3)) for r in segments.collect()) == [(1, 1, 10.0), (1, 2, 20.0), (1, 3, 50.0), (1, 4, 100.0), (2, 1, 1205.015)]
    (tmp_path / "map.json").write_text(json.dumps({"version": 1, "items": [{"source_youtube_path": "x/vid_clean.txt", "whisper_prefix": "_vid", "whisper_folder_path": "parts"}]}))
    mapped = transcripts.jobs_from_map(transcripts.read_align_map(spark, str(tmp_path / "map.json")), segments)
    paired = transcripts.jobs_from_folders(lines.withColumn("source_file", F.lit("x/vid.txt")), segments)
    assert mapped.count() == paired.count() == 5 and {r["job"] for r in mapped.collect()} == {"vid"}
    got = {(r["part"], r["source_index"]): r for r in jobs.align(mapped, lines).withColumn("part", F.regexp_extract("source_file", r"_(\d+)\.json", 1).cast("int")).collect()}
    good = got[1, 1]
    assert good["reason"] is None and good["matched_text"] == "xin chào các bạn." and good["score"] == 104.0 and good["chars_per_sec"] == 4.25 and (good["start"], good["global_end"]) == (10.0, 14.0)
    # before 20 s the last caption of a beginning that starts early enough; a segment of no length
    assert got[1, 2]["reason"] in ("STRUCTURE_FAIL", "LOW_SCORE") and got[1, 3]["reason"] == "STRUCTURE_FAIL" and got[1, 3]["chars_per_sec"] is None
    # a caption in the second before the segment is in neither join, the one before it is
    assert "quá" not in (got[1, 4]["matched_text"] or "") and got[2, 1]["reason"] is None and got[2, 1]["global_start"] == 1205.015
    assert {r["reason"] for r in jobs.align(mapped, lines.where("start > 2000")).collect()} == {"NO_CANDIDATE"}
    # the same job, written and read again
    json_files.write_arrays(jobs.align(mapped, lines).where("reason is null"), str(tmp_path / "out"), "job", "global_start")
    assert [r["source_index"] for r in json_files.read_array_files(spark, str(tmp_path / "out"), schemas.ALIGNED, strict=True).orderBy("source_index").collect()] == [0, 1]


def test_factory_counts_every_row(spark, tmp_path):
    row = {"start": 0, "end": 1.5, "matched_text": "Tôi có 21 con", "score": 90, "chars_per_sec": 8}
    folder = write(tmp_path / "in", {"a.json": [row, 7, {**row, "matched_text": "  "}, {**row, "matched_text": "17ảy"}, {**row, "end": None}, {**row, "audio_path": "x.wav"}, None, [1]], "b.json": {**row, "source_file": "s.wav"}, "c.json": [], "d.json": "[{", "e.json": "12"})
    files = json_files.read_files(spark, folder)
    rows = jobs.factory(files).cache()
    assert jobs.factory_counters(rows).first().asDict() == {"FILES": 5, "KEEP": 3, "REJECT": 6, "READ_ERROR": 1, "BAD_FORMAT": 2}
    kept, rejected = json_files.split_rejects(rows)
    assert sorted((r["source_json"][-6:], r["source_index"], r["matched_text"], r["audio_path"]) for r in kept.collect()) == [("a.json", 0, "tôi có hai mươi mốt con", ""), ("a.json", 5, "tôi có hai mươi mốt con", "x.wav"), ("b.json", 0, "tôi có hai mươi mốt con", "s.wav")]
    reasons = sorted((r["source_json"][-6:], -1 if r["source_index"] is None else r["source_index"], r["reject_reason"], r["row_type"]) for r in rejected.collect())
    assert reasons == [("a.json", 1, "BAD_ROW_TYPE", "int"), ("a.json", 2, "VALIDATE_FAIL", "dict"), ("a.json", 3, "CLEAN_TEXT_EMPTY", "dict"), ("a.json", 4, "VALIDATE_FAIL", "dict"), ("a.json", 6, "BAD_ROW_TYPE", "NoneType"), ("a.json", 7, "BAD_ROW_TYPE", "list"), ("c.json", -1, "EMPTY_FILE", None), ("d.json", -1, "READ_ERROR", None), ("e.json", -1, "BAD_FORMAT", None)]
    assert sorted(r["audio_path"] for r in jobs.metadata(kept).collect()) == ["s.wav", "x.wav"]
    json_files.write_lines(rejected, str(tmp_path / "rejects"), "overwrite")
    json_files.write_lines(rejected, str(tmp_path / "rejects"), "overwrite")
    assert spark.read.json(str(tmp_path / "rejects")).count() == 9
    assert "EMPTY_FILE | 1" in report.render({"rejects": report.counters(rejected, "reject_reason")})


def test_caption_cleaning(spark, tmp_path):
    folder = write(tmp_path / "raw", {"v.txt": "0:044 giây xin chào\n\n0:044 giây xin chào\nno time\n1:02:033 giờ, 1 phút chào\n0:07 44 giây\n"})
    kept, rejected = transcripts.clean_captions(transcripts.lines_of(spark, folder))
    assert [(r["time"], r["text"]) for r in kept.orderBy("idx").collect()] == [("00:00:04", "xin chào"), ("01:02:03", "chào")] and sorted(r["line"] for r in rejected.collect()) == ["0:07 44 giây", "no time"]
    transcripts.write_captions(kept, str(tmp_path / "clean"))
    again = transcripts.read_captions(spark, str(tmp_path / "clean"))
    assert [(r["start"], r["text"]) for r in again.orderBy("idx").collect()] == [(4, "xin chào"), (3723, "chào")]
    transcripts.write_rejected_lines(rejected, str(tmp_path / "lines"))
    assert all("v.txt | " in r["value"] for r in spark.read.text(str(tmp_path / "lines")).collect())
    listing = transcripts.list_files(spark, folder, "*.txt")
    jobs_ = transcripts.caption_jobs(spark.createDataFrame([("v", "a/v.txt", "_v", "p"), ("w", "a/w.txt", "_w", "p")], "job string, source_youtube_path string, whisper_prefix string, whisper_folder_path string"), listing)
    assert [(r["job"], r["clean_name"]) for r in jobs_.collect()] == [("v", "v_clean.txt")]
    old = spark.createDataFrame([("[1.5 - 2.25] (score=97.1)  chào bạn",), ("[x - 2] (score=1) a",), ("text",)], "l string").select(transcripts.aligned_line(F.col("l")).alias("s"))
    assert [None if r["s"] is None else tuple(r["s"]) for r in old.collect()] == [(1.5, 2.25, 97.1, "chào bạn"), None, None]


def test_lines_with_numbers(spark, tmp_path):
    write(tmp_path / "x", {"m.jsonl": '{"audio": "a.wav", "text": "x"}\n\n{"audio": \n[1]\n{"audio": "b.wav"}\n'})
    rows = json_files.read_numbered_lines(spark, str(tmp_path / "x"), "audio string, text string").orderBy("line_no").collect()
    assert [(r["line_no"], r["audio"], r["line_error"]) for r in rows] == [(1, "a.wav", None), (3, None, '{"audio": '), (4, None, "[1]"), (5, "b.wav", None)]
    df = spark.createDataFrame([("a", 1), ("b", 2)], "name string, n int")
    json_files.write_each(df, str(tmp_path / "each"), "name")
    assert {r["name"]: json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "each")).collect()} == {"a": {"n": 1}, "b": {"n": 2}}


def tone(seconds, quiet=0.0, rate=16_000, width=2, channels=1):
    x = np.r_[np.zeros(int(quiet * rate)), np.sin(np.arange(int(seconds * rate)) / 5) * 0.5, np.zeros(int(quiet * rate))]
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels), w.setsampwidth(width), w.setframerate(rate)
        w.writeframes(np.repeat(x * 32767, channels).astype("<i2").tobytes())
    return out.getvalue()


def test_audio_models_and_validation(spark, tmp_path):
    for name, content in {"a.wav": tone(1.5, 0.5), "b.wav": tone(0.5, 0, 8000, channels=2), "c.wav": b"RIFF", "n.txt": b""}.items():
        (tmp_path / name).write_bytes(content)
    files = audio.read_audio(spark, str(tmp_path))
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    timed = files.select(name.alias("path"), audio.wav_duration("content").alias("d")).select("path", "d.*")
    assert {r["path"]: (r["duration"], r["rate"], r["error"] is None) for r in timed.collect()} == {"a.wav": (2.5, 16000, True), "b.wav": (0.5, 8000, True), "c.wav": (None, None, False)}
    meta = spark.createDataFrame([("a.wav", "x", 2.0), ("b.wav", " ", None), ("c.wav", "x", 1.0), (None, "x", 1.0)], "audio string, text string, duration double")
    got = jobs.validate(meta, timed).first().asDict()
    assert {k: got[k] for k in ("rows", "empty_text", "missing_audio", "bad_duration", "duration_mismatch", "minutes")} == {"rows": 4, "empty_text": 1, "missing_audio": 2, "bad_duration": 1, "duration_mismatch": 1, "minutes": 0.05}
    rows = models.run_model(files, models.speech_by_energy, models.INTERVALS, models.GO_ON).withColumn("path", name).collect()
    found = {r["path"]: r for r in rows}
    assert len(rows) == 3 and abs(found["a.wav"]["start"] - 0.5) < 0.05 and abs(found["a.wav"]["end"] - 2.0) < 0.05 and found["c.wav"]["error"] and found["c.wav"]["start"] is None
    with pytest.raises(Exception, match="EOFError|Error"):
        models.run_model(files, models.speech_by_energy, models.INTERVALS).collect()
    cut = audio.clips(files, files.where(name == "a.wav").select(F.col("path").alias("source_audio_path"), F.lit("clip").alias("audio"), F.lit(0.25).alias("cut_start"), F.lit(1.25).alias("cut_end")))
    clip = cut.first()
    assert clip["duration"] == 1.0 and audio.duration_of(bytes(clip["content"]))[0] == 1.0
    plan = jobs.clip_plan(spark.createDataFrame([("a", "x", None, 1.0, 2.0, 90.0, 5.0, 0), ("a", "", "y", 0.5, 2.4, 90.0, 5.0, 1), ("b", "x", "", 2.0, 1.0, 1.0, 1.0, 2)], "audio_path string, text string, matched_text string, start double, end double, score double, chars_per_sec double, source_index int"), spark.createDataFrame([("a", 2.5)], "path string, duration double"))
    assert [(r["text"], r["cut_start"], r["cut_end"], r["duration"]) for r in plan.orderBy("source_index").collect()] == [("x", 0.0, 2.5, 2.5), ("y", 0.0, 2.5, 2.5)]


def test_speech_groups_and_adjusted_spans(spark):
    spans = spark.createDataFrame([("f", 0, 0.0, 5.0), ("f", 1, 5.0, 10.0), ("f", 2, 11.0, 11.5)], "k string, span long, vs double, ve double")
    segments = spark.createDataFrame([("f", 0, 0.5, 2.0, "một"), ("f", 1, 2.0, 6.0, "hai ba"), ("f", 2, 7.0, 8.0, "bốn"), ("f", 3, 11.1, 11.3, "năm sáu")], "k string, seg long, s double, e double, text string")
    assert [tuple(r) for r in jobs.speech_groups(spans, segments, "k").select("span", "start", "end", "text").collect()] == [(0, 0.5, 6.0, "một hai ba")]
    word = lambda w, s, p=0.9: {"word": w, "start": s, "end": s + 0.3, "probability": p, "score": None}
    words = [word(" một", 0.4), word("hai", 0.8), word("3", 1.2), word("bốn ", 1.6)]
    base = dict(index=0, audio="a", text_expected="một hai ba bốn", original_start=10.4, original_end=11.9, cut_start=10.0, cut_end=13.0, words=[])
    rows = [{**base, "segments": [{"start": 0.0, "end": 2.0, "text": "", "words": words}]}, {**base, "index": 1, "segments": [], "words": []}, {**base, "index": 2, "original_start": None, "segments": [], "words": words}, {**base, "index": 3, "text_expected": "sáu bảy", "segments": [], "words": words}]
    got = {r["index"]: r for r in jobs.adjust(spark.createDataFrame(rows, schemas.WORD_ROW)).collect()}
    assert (got[0]["status"], got[0]["reject_reason"], got[0]["new_start"], got[0]["new_end"], got[0]["delta_start"]) == ("OK", "OK", 10.4, 11.9, 0.0) and got[0]["score"] == 100.0
    assert (got[1]["status"], got[1]["new_start"], got[1]["reject_reason"]) == ("NO_WORDS", None, "NO_WORDS") and got[2]["reject_reason"] == "BAD_EXPECTED_TIME"
    assert got[3]["status"] == "REJECT" and got[3]["reject_reason"].startswith("NO_GOOD_SPAN|") and (got[3]["new_start"], got[3]["delta_end"]) == (10.4, 0.0)
    aligned = jobs.adjust(spark.createDataFrame(rows[:1], schemas.WORD_ROW), span.ALIGNED).select(jobs.aligned_status(F.col("score"), F.lit(None).cast("string")).alias("s"))
    assert aligned.first()["s"] == "OK" and quality.OLD_SPANS.score == 70


def test_resuming(spark, tmp_path):
    """What is done once isn't done again, by the stream's checkpoint and by the done log."""
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    spark.range(3).write.parquet(source)
    schema = spark.read.parquet(source).schema
    assert incremental.load_available(spark, source, schema, state).count() == 3
    spark.range(10, 12).write.mode("append").parquet(source)
    assert incremental.load_available(spark, source, schema, state).count() == 5
    assert incremental.load_available(spark, source, schema, state).count() == 5
    inputs = spark.createDataFrame([("a", "a.json"), ("b", "b.json")], "input string, output string")
    log = str(tmp_path / "log")
    json_files.write_lines(incremental.logged(inputs.where("input = 'a'")), log, "append")
    done = json_files.read_lines(spark, log, schemas.DONE_LOG)
    assert [r["input"] for r in incremental.pending(inputs, done).collect()] == ["b"] and done.first()["done_at"][4] == "-"
    json_files.write_lines(incremental.logged(incremental.pending(inputs, done)), log, "append")
    assert incremental.pending(inputs, json_files.read_lines(spark, log, schemas.DONE_LOG)).count() == 0
