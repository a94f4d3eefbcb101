"""The command line from files to answers."""

import json

from quillgraph import cli


def lines(path):
    return [json.loads(x) for f in sorted(path.glob("*.json")) for x in f.read_text().splitlines()]


def test_commands(spark, tmp_path, capsys):
    docs = tmp_path / "docs"
    docs.mkdir()
    (docs / "a.txt").write_text("See (Apple - Company - maker) and [Apple -> iPhone: produces] here.")
    (docs / "a.md").write_text("# 标题\n" + "压力容器设计。" * 200)
    cli.main(["rag-build", "--input", str(docs), "--state", str(tmp_path / "s"), "--gexf", str(tmp_path / "g.gexf")], spark)
    cli.main(["rag-query", "--state", str(tmp_path / "s"), "-q", "apple"], spark)
    assert "实体: Apple" in capsys.readouterr().out and (tmp_path / "g.gexf").exists()
    (tmp_path / "q.jsonl").write_text('{"question": "apple"}\n{"question": "other", "answer": "known"}\n')
    cli.main(["batch", "--state", str(tmp_path / "s"), "--dataset", str(tmp_path / "q.jsonl"), "--output", str(tmp_path / "o")], spark)
    got = {r["question"]: r for r in lines(tmp_path / "o")}
    assert got["other"]["answer"] == "known" and got["apple"]["failed"] is True
    cli.main(["dataset", "--input", str(docs), "--output", str(tmp_path / "d"), "--files", "1"], spark)
    assert len(lines(tmp_path / "d")) == 2
    cli.main(["preprocess", "--input", str(docs), "--output", str(tmp_path / "p"), "--dry-run"], spark)
    assert lines(tmp_path / "p")[0]["files"] == 1
