import hashlib

from pyspark.sql import functions as F

from quillstone.sources import moves as M


def sha(x):
    return hashlib.sha256(x).hexdigest()


def test_copies_moves_and_conflicts(spark, tmp_path):
    old, new = tmp_path / "old", tmp_path / "new"
    old.mkdir(), new.mkdir()
    big = bytes(range(256)) * 40_000
    for name, content in (("a", b"1"), ("b", b"2"), ("c", b"3"), ("d", b"4"), ("e", big), ("empty", b"")):
        (old / name).write_bytes(content)
    (new / "b").write_bytes(b"2"), (new / "c").write_bytes(b"other")
    rows = [(f"{old}/{x}", f"file://{new}/{x}", x) for x in ("a", "b", "c", "e", "empty", "none")] + [(f"{old}/d", f"file://{new}/sub/dir/a", "d"), (f"{old}/a", f"file://{new}/sub/dir/a", "a2"), (None, f"{new}/x", "null"), (f"{old}/a", None, "null2"), (f"{old}/a", f"{new}/b/under", "bad")]
    plan = spark.createDataFrame(rows, "source string, target string, error_of string")
    got = {r.error_of: r for r in M.copy_files(plan).collect()}
    assert {k: r.outcome for k, r in got.items()} == {"a": "copied", "b": "same", "c": "conflict", "e": "copied", "empty": "copied", "none": "missing", "a2": "copied", "d": "conflict", "null": "failed", "null2": "failed", "bad": "failed"}
    assert got["e"].sha256 == sha(big) and got["e"].n_bytes == len(big) and (new / "e").read_bytes() == big and (new / "empty").read_bytes() == b""
    assert (new / "c").read_bytes() == b"other" and (new / "sub/dir/a").read_bytes() == b"1" and got["bad"].error
    assert not [p for p in tmp_path.rglob(".staging-*")]
    assert M.copy_files(plan).columns == M.copy_files(plan).columns and len(plan.columns) == 3
    assert {r.outcome for r in M.copy_files(plan.filter("error_of in ('a', 'b', 'e')")).collect()} == {"same"}
    moved = M.copy_files(plan.filter("error_of in ('a', 'c', 'e')"), move=True, overwrite=True).collect()
    assert {r.error_of: r.outcome for r in moved} == {"a": "same", "c": "copied", "e": "same"}
    assert (new / "c").read_bytes() == b"3" and not (old / "a").exists() and not (old / "c").exists() and (old / "b").exists()


def test_a_killed_task_leaves_no_half_file(spark, tmp_path):
    """The task dies in the middle of a file: the target is not there, and the repetition finishes it."""
    fs, target = M.opened(str(tmp_path / "t" / "x"))

    def dying():
        yield b"half"
        raise RuntimeError("killed")

    try:
        M.placed(fs, target, dying())
        raise AssertionError
    except RuntimeError:
        assert not (tmp_path / "t" / "x").exists()
    (tmp_path / "s").write_bytes(b"whole")
    plan = spark.createDataFrame([(str(tmp_path / "s"), str(tmp_path / "t" / "x"))], "source string, target string")
    assert [r.outcome for r in M.copy_files(plan).collect()] == ["copied"] and (tmp_path / "t" / "x").read_bytes() == b"whole"
    assert [p.name for p in (tmp_path / "t").iterdir()] == ["x"]
    assert M.copy_files(plan.limit(0)).count() == 0 and M.write_files(spark.createDataFrame([], "path string, content binary")) == 0
    assert M.copy_files(plan.withColumn("n_bytes2", F.lit(1))).columns == ["source", "target", "n_bytes2", "outcome", "sha256", "n_bytes", "error"]


def test_paper_files_are_written_listed_and_read_by_tasks(spark, tmp_path):
    from quillstone.sources import readers as R
    from quillstone.sources import sinks as K

    odd = ["a/b", "x:y=z", 'q"[1]{^}', "50%", "ü\U0001f600", "tab\there", "back\\slash", "", None, "plain"]
    rows = spark.createDataFrame([(x, f"p{k}") for k, x in enumerate(odd)] + [("plain", "p99")], "paper_id string, payload string")
    folder = str(tmp_path / "papers")
    assert K.write_per_paper(rows.filter("payload = 'p0'"), folder) == 1
    assert K.write_per_paper(rows.withColumn("payload", F.concat("payload", F.lit("!"))).filter("payload <> 'p0'"), folder) == len(odd)
    assert K.write_per_paper(rows, folder) == 0
    rows.write.partitionBy("paper_id").text(str(tmp_path / "spark"))
    assert {p.parent.name for p in (tmp_path / "papers").rglob("*.txt")} == {p.name for p in (tmp_path / "spark").glob("paper_id=*")}
    assert not [p for p in (tmp_path / "papers").rglob("*") if p.name.startswith((".", "_"))]
    files = R.list_files(spark, folder, "*.txt", deep=True)
    assert files.inputFiles() == []  # the driver has no list of them
    assert sorted(r.content.decode() for r in files.collect()) == sorted(["p0\n", *[f"p{k}!\n" for k in range(1, 9)], "p9!\np99!\n"])
    assert R.list_files(spark, folder, "*.txt").count() == 0 and R.list_files(spark, folder, "*.pdf", deep=True).count() == 0
    assert K.write_per_paper(rows.limit(0), str(tmp_path / "none")) == 0 and R.list_files(spark, str(tmp_path / "none"), "*.txt", deep=True).count() == 0


def test_json_documents_are_listed_and_read_by_tasks(spark, tmp_path):
    from quillstone.sources import readers as R

    for name, text in (("a/d.json", '{\n "name": "x",\n "n": 1}'), ("b/c/d.json", '[{"name": "y"}, {"name": "z"}]'), ("bad/d.json", "{no"), ("empty/d.json", " \n"), ("list/d.json", "[]"), ("_not/d.json", '{"name": "hidden"}')):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    found = R.read_json_documents(spark, str(tmp_path), "name string")
    assert found.inputFiles() == []  # the driver has no list of them
    assert sorted((r.folder.removeprefix(f"file:{tmp_path}/"), r.name or "") for r in found.collect()) == [("a", "x"), ("b/c", "y"), ("b/c", "z"), ("bad", "")]
