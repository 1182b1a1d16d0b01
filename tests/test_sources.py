"""Readers and writers of JSON files."""

from cantora.sources import json_files

SEGMENT = "start double, end double, text string"


def test_array_files(spark, tmp_path):
    contents = {
        "a": '[{"start": 0, "end": 1.5, "text": "một"}, 7, {"start": 2, "text": null}]', "b": '{"start": 3, "end": 4, "text": "x"}', "c": '{"segments": [{"start": 5, "end": 6, "text": "y"}]}',
        "d": "[{", "e": "[]", "f": "12", "g": '"[{\\"start\\": 8, \\"end\\": 9, \\"text\\": \\"z\\"}]"',
    }
    for name, text in contents.items():
        (tmp_path / f"{name}.json").write_text(text)

    def got(**options):
        df = json_files.read_array_files(spark, str(tmp_path), SEGMENT, **options)
        return sorted(((r["source_file"][-6], r["source_index"], r["start"], r["end"], r["text"]) for r in df.collect()), key=lambda r: r[:2])

    listed = [("a", 0, 0.0, 1.5, "một"), ("a", 2, 2.0, None, None)]
    assert got(strict=True) == listed
    assert got() == [*listed, ("b", 0, 3.0, 4.0, "x"), ("c", 0, None, None, None), ("g", 0, 8.0, 9.0, "z")]
    assert got(envelope="segments") == [*listed, ("b", 0, 3.0, 4.0, "x"), ("c", 0, 5.0, 6.0, "y"), ("g", 0, 8.0, 9.0, "z")]


def test_lines(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"start": 1, "end": 2, "text": "a"}\n\n{"start": \n{"start": 3}\n')
    rows = json_files.read_lines(spark, str(tmp_path / "x.jsonl"), SEGMENT)
    assert sorted(tuple(r) for r in rows.collect()) == [(1.0, 2.0, "a"), (3.0, None, None)]
    json_files.write_lines(rows, str(tmp_path / "out"))
    assert sorted(tuple(r) for r in json_files.read_lines(spark, str(tmp_path / "out"), SEGMENT, strict=True).collect()) == [(1.0, 2.0, "a"), (3.0, None, None)]
