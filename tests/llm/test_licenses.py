from __future__ import annotations

import re
import textwrap

import pytest

from headway.llm import licenses, queries
from tests.compare import same

from .frames import awkward, empty


def found(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = licenses.scan(df).orderBy("doc_id").collect()
    return [[(x["license"], x["rule"]) for x in r["licenses"]] for r in rows]


def words(text: str) -> str:
    return " ".join(re.findall("[a-z0-9]+", text.translate(str.maketrans(licenses.UPPER, licenses.LOWER))))


def brute(text: str | None) -> tuple[list[str], list[tuple[str, str]]]:
    """Sentence by sentence, and line by line where no run of lines up to the sentence's end is known."""
    table = {words(s): name for name, s in licenses.SENTENCES.items()}
    if not re.search(licenses.MARKS, (text or "").lower()):
        return [], []
    ids = []
    text = re.sub(r"((?:^|[^A-Za-z0-9])[vV])\.([ \t\r\n]+[0-9])", r"\1\2", text or "")
    for paragraph in re.split(r"[ \t\r]*\n[ \t\r]*\n[ \t\r\n]*", text):
        for sentence in re.split(r"(?<=[.!?;])[ \t\r\n]+", paragraph):
            lines = [x for x in map(words, sentence.split("\n")) if x]
            known = [i for i in range(len(lines)) if " ".join(lines[i:]) in table]
            first = known[0] if known else len(lines)
            ids += [table[x] for x in lines[:first] if x in table]
            if known:
                ids.append(table[" ".join(lines[first:])])
    hits = []
    for name, kind, rule in licenses.RULES:
        if any(tuple(ids[i : i + len(rule)]) == rule for i in range(len(ids))) and (name, kind) not in hits:
            hits.append((name, kind))
    return ids, hits


def whole(ids, end="\n"):
    return end.join(licenses.SENTENCES[i] for i in ids)


@pytest.mark.parametrize("rule", licenses.RULES, ids=lambda r: "-".join(r[2]))
def test_each_rule_is_found_in_lines_and_wrapped(spark, rule):
    name, kind, ids = rule
    lines = "Some words first\n" + whole(ids) + "\nand more after"
    ended = lambda i: licenses.SENTENCES[i] + (" " if licenses.SENTENCES[i][-1] in ".;" else "\n\n")
    flowing = "\n\n".join(["A title", *(textwrap.fill(x, 60) for x in "".join(map(ended, ids)).split("\n\n")), "The end."])
    loud = whole(ids).upper()
    for text, hits in zip((lines, flowing, loud), found(spark, lines, flowing, loud), strict=True):
        assert (name, kind) in hits
        assert hits == brute(text)[1]


def test_order_and_neighbours_count(spark):
    mit = ["mit_grant", "mit_notice", "mit_as_is", "mit_liability"]
    right, wrong, cut, between = whole(mit), whole(mit[::-1]), whole(mit[:3]), whole([*mit[:2], "gpl_see", *mit[2:]])
    apart = whole(mit, "\nsomething else\n")
    assert [("MIT", "text") in hits for hits in found(spark, right, wrong, cut, between, apart)] == [True, False, False, False, True]


def test_titles_and_wrapped_notices_are_found_in_one_text(spark):
    wrapped = textwrap.fill(" ".join(licenses.SENTENCES[i] for i in ("gpl3_later", "gpl_hope", "gpl_see", "gpl_received")), 60)
    mit = textwrap.fill(licenses.SENTENCES["mit_grant"], 50)
    texts = ["MIT License\n" + wrapped[wrapped.index("This program is distributed") :], "MIT License\n\n" + wrapped, wrapped + "\nMIT License\nCopyright (c) 2020 someone\n" + mit, mit + "\n\n" + wrapped]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = licenses.scan(df).orderBy("doc_id").collect()
    ids = [r["license_sentences"] for r in rows]
    assert ids[0] == ["mit_title2", "gpl_hope", "gpl_see", "gpl_received"]
    assert ids[1] == ["mit_title2", "gpl3_later", "gpl_hope", "gpl_see", "gpl_received"]
    assert ids[2] == ["gpl3_later", "gpl_hope", "gpl_see", "gpl_received", "mit_title2", "mit_grant"]
    assert ids[3] == ["mit_grant", "gpl3_later", "gpl_hope", "gpl_see", "gpl_received"]
    assert [brute(t)[0] for t in texts] == ids


def test_versions_are_told_apart(spark):
    text = "This Source Code Form is subject to the terms of the Mozilla Public License, v. %s."
    assert found(spark, text % "1.1", text % "2.0", (text % "2.0").replace("v. ", "v.\n")) == [[], [("MPL-2.0", "notice")], [("MPL-2.0", "notice")]]


def test_a_long_run_of_lines_takes_little_time(spark):
    assert found(spark, "\n".join(["this software of mine"] * 50_000) + "\nMIT License") == [[("MIT", "title")]]


def test_plain_texts_have_none(spark):
    assert found(spark, "He had a driving license.", "permission was granted", "all rights", "MIT is in Boston") == [[], [], [], []]


def test_op4_agrees_with_sql(spark, sf_dir):
    same(queries.op4_licenses(spark, sf_dir), queries.oracle_sql()["op4_licenses"], sf_dir)


def test_op4_finds_the_notices_of_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in queries.op4_licenses(spark, sf_dir).collect():
        ids, hits = brute(texts[r["doc_id"]])
        assert r["sentences"] == ",".join(ids)
        assert r["licenses"] == ",".join(f"{a}:{b}" for a, b in hits)


def test_awkward_rows(spark):
    df = awkward(spark, "licenses", "license_sentences", "ids")
    rows = licenses.scan(df).collect()
    assert len(rows) == df.count()
    assert all(r["licenses"] == [] and r["license_sentences"] == [] and r["ids"] == "clash" for r in rows)
    assert licenses.scan(empty(spark)).count() == 0


def test_no_python_runs(spark, sf_dir):
    plan = queries.op4_licenses(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Exchange"))
