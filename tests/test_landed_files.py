"""Baskets in any quoting and encoding against Python's csv, and artifacts recomputed from files."""

import csv
import hashlib
import io
import json
import random

import pytest

from holdfast.sources import landed


def by_hand(content):
    try:
        text = content.decode("utf-8-sig")
    except UnicodeDecodeError:
        text = content.decode("cp949")
    table = [r for r in csv.reader(io.StringIO(text, newline="")) if any(c.strip() for c in r)]
    names = [landed.BASKET_HEADERS.get("".join(h.split()).lower()) for h in table[0]]
    out = []
    for i, cells in enumerate(table[1:], start=2):
        own = {n: cells[k].strip() if k < len(cells) else "" for k, n in reversed(list(enumerate(names))) if n}
        out.append((i, *[own.get(c) or None for c in landed.BASKET]))
    return out


def test_baskets_of_any_quoting_and_encoding(spark, tmp_path):
    rng = random.Random(7)
    names = ["삼성전자", 'a "b" c', "one, two", "line\nbreak", "cr\r\nlf", "", " ", '5" pipe', "x"]
    files = {}
    for k in range(12):
        header = rng.sample(["기준일", "종목 명", "표준코드", "종목코드", "비중(%)", "note", "수량", "name"], 8)
        buffer = io.StringIO(newline="")
        writer = csv.writer(buffer, lineterminator=rng.choice(["\n", "\r\n"]), quoting=rng.choice([csv.QUOTE_ALL, csv.QUOTE_MINIMAL]))
        writer.writerow(header)
        for _ in range(rng.randrange(12)):
            writer.writerow([rng.choice(names) for _ in range(rng.randrange(1, 10))])
        text = buffer.getvalue() + rng.choice(["", "\n\n", ",,,\n", 'ab"c,d"e\n', '"open, end'])
        files[f"b{k}.csv"] = text.encode(rng.choice(["utf-8", "utf-8-sig", "cp949"]))
    refused = {"r0.csv": (b"name,weight\nx,1\n", "neither a column of ISINs nor of codes"), "r1.csv": (b"code,weight\n1,1\n", "no column of names"), "r2.csv": (b"\n \n", "no header row"), "r3.csv": (b"name,code\n\xff\xff\xfe,1\n", "neither UTF-8 nor cp949")}
    for name, content in (files | {k: c for k, (c, _) in refused.items()}).items():
        (tmp_path / name).write_bytes(content)
    got = {}
    for r in landed.basket_csv(spark, str(tmp_path)).collect():
        got.setdefault(r["document"].rsplit("/", 1)[1], []).append(tuple(r)[1:])
    for name, content in files.items():
        assert sorted(got.pop(name, [])) == by_hand(content), name
    assert got == {}
    assert {r["document"].rsplit("/", 1)[1]: r["problem"] for r in landed.basket_problems(spark, str(tmp_path)).collect()} == {k: p for k, (_, p) in refused.items()}


@pytest.mark.parametrize("size", [400, 3000])
def test_baskets_in_splits(spark, tmp_path, size):
    rng = random.Random(size)
    names = ["삼성전자", 'a "b" c', "one, two", "line\nbreak", "cr\r\nlf", "", '5" pipe', "x", "long\n,\"" * 30]
    files = {}
    for k in range(4):
        buffer = io.StringIO(newline="")
        writer = csv.writer(buffer, lineterminator=rng.choice(["\n", "\r\n"]), quoting=rng.choice([csv.QUOTE_ALL, csv.QUOTE_MINIMAL]))
        writer.writerows([[" "]] * 30 * (k % 2) + [["종목 명", "종목코드", "note"]])
        writer.writerows([rng.choice(names) for _ in range(4)] for _ in range(40))
        files[f"b {k}+.csv"] = (buffer.getvalue() + ("x,1" if k else '"open,\nend')).encode(rng.choice(["utf-8", "utf-8-sig", "cp949"]))
    for name, content in (files | {"blank.csv": b" \n" * 400}).items():
        (tmp_path / name).write_bytes(content)
    set_, cost = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    try:
        spark.conf.set(set_, size)
        spark.conf.set(cost, 0)
        assert landed._basket_lines(spark, str(tmp_path)).rdd.getNumPartitions() > 8
        got = {}
        for r in landed.basket_csv(spark, str(tmp_path)).collect():
            got.setdefault(r["document"].rsplit("/", 1)[1], []).append(tuple(r)[1:])
        problems = [r["problem"] for r in landed.basket_problems(spark, str(tmp_path)).collect()]
    finally:
        spark.conf.unset(set_)
        spark.conf.unset(cost)
    assert {k: sorted(v) for k, v in got.items()} == {k: by_hand(v) for k, v in files.items()}
    assert problems == ["no header row"]


def test_plain_baskets_are_parsed_once(spark, tmp_path):
    """Files without line breaks in quotes over ends of splits: one pass, regular records by columns, whatever lies between them."""
    header, line = "종목명,note,종목코드,종목 명,비중(%)\n", "삼성전자,x,005930,no,1%\n"
    odd = [",,,,\n", ",only a note,,,\n", ",,,,,beyond\n", "short,x\n", '"one, ""two""",x,1,no,\n', ' a"b ,x,"line\nbreak",no,\n', "\n", "\u3000,\t,,,\n", '"",x,"","",\n']
    texts = {"regular.csv": header + line * 3, "blank.csv": header + line + ",,,,\n \n\r\n" + line, "odd.csv": "\n,\n" + header + line.join(odd), "none.csv": header}
    files = {f"{e}-{k}": t.encode(e) for k, t in texts.items() for e in ("utf-8", "utf-8-sig", "cp949")}
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    out = landed.basket_csv(spark, str(tmp_path))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "regexp_extract_all" not in plan
    got = {}
    for r in out.collect():
        got.setdefault(r["document"].rsplit("/", 1)[1], []).append(tuple(r)[1:])
    for name, content in files.items():
        assert sorted(got.pop(name, [])) == by_hand(content), name
    assert got == {}
    numbers = landed.basket_csv(spark, str(tmp_path)).select("name")
    assert "Window" not in numbers._jdf.queryExecution().executedPlan().toString()


def test_text_behind_a_closing_quote(spark, tmp_path):
    (tmp_path / "a.csv").write_text('name,code\n"ab"c,1\n"d""e"f" ,2\nx"y"z,3\n')
    assert [r["name"] for r in landed.basket_csv(spark, str(tmp_path)).orderBy("row_number").collect()] == ["ab", 'd"e"f', 'x"y"z']


@pytest.mark.parametrize("large", [1 << 27, 100])
def test_artifacts(spark, tmp_path, large):
    rng = random.Random(8)
    expected = {}
    for k in range(7):
        days = [f"2026-01-0{rng.choice([1, 1, 1, 2]) if k % 2 else 1}" for _ in range(rng.randrange(9))]
        lines = [json.dumps({"as_of": d, "url": "é"}) for d in days] + ([json.dumps({"url": "é"})] if k == 4 else [])
        data = ("\n".join(lines) + rng.choice(["", "\n", "\n\n  \n"])).encode()
        place = tmp_path / f"part {k}" / "a+b.jsonl"
        place.parent.mkdir()
        place.write_bytes(data)
        day = days[0] if days and len(set(days)) == 1 and k != 4 else None
        expected[f"part {k}"] = (hashlib.sha256(data).hexdigest(), len(data), len(lines), day, "é" if lines else None)
    out = landed.artifacts(spark, str(tmp_path), {"as_of": "string", "url": "string"}, large=large, piece=64)
    assert {r["path"].replace("%20", " ").rsplit("/", 2)[1]: tuple(r)[1:] for r in out.collect()} == expected
