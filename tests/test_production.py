"""The cleaning job against a plain row-by-row reading of its rules."""

import json
import random
import re

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from marquetry.plans import production
from marquetry.schemas import CREW_RAW, PERSON_RAW, PRODUCTION_RAW
from marquetry.sources import readers
from marquetry.sources.readers import read_jsonl_tolerant

BROKEN = ['{"id_pessoa": 1', "", "not json", '{"id_pessoa": 5} trailing', "[1]"]

PEOPLE = [
    {"id_pessoa": 1, "nome": "  Ana   Lima "},
    {"id_pessoa": 1, "nome": "second copy"},
    {"id_pessoa": 2, "nome": "Bia\u00a0Reis"},
    {"id_pessoa": 3, "nome": "   "},
    {"id_pessoa": 4},
    {"id_pessoa": None, "nome": "nobody"},
    {"nome": "nobody either"},
    {"id_pessoa": 5, "nome": "Caio"},
]
WORKS = [
    {"id_producao": 10, "titulo": " A  B ", "ano": "#2004", "tipo_id": "1"},
    {"id_producao": 10, "titulo": "copy", "ano": "1990", "tipo_id": "1"},
    {"id_producao": 11, "titulo": None, "ano": "ano: 1999", "tipo_id": "3.7"},
    {"id_producao": 12, "titulo": "x", "ano": "abc", "tipo_id": "2"},
    {"id_producao": 13, "titulo": "x", "ano": "1799", "tipo_id": "x"},
    {"id_producao": 14, "titulo": "x", "ano": "1800", "tipo_id": None},
    {"id_producao": 15, "titulo": "x", "ano": "2100"},
    {"id_producao": 16, "titulo": "x", "ano": "2101"},
    {"id_producao": 17, "titulo": "x", "ano": "9" * 30},
    {"id_producao": 18, "titulo": "x", "ano": 2010, "tipo_id": 7},
    {"id_producao": None, "titulo": "x", "ano": "2000"},
]


def crew_lines(seed):
    rng = random.Random(seed)
    roles = ["Ator", " Ator ", "Ator\t", "Diretor", "", "  ", None, "Diretor  geral"]
    rows = [{"id_producao": 10, "id_pessoa": 1, "papel": "Ator"}] * 60
    for _ in range(140):
        rows.append(
            {
                "id_producao": rng.choice([10, 11, 12, 18, 99, None]),
                "id_pessoa": rng.choice([1, 2, 3, 77, None]),
                "papel": rng.choice(roles),
            }
        )
    rng.shuffle(rows)
    return rows


def tidy(text):
    return re.sub(r"\s+", " ", text.strip())


def expected_crew(rows, people, works):
    seen, stats = set(), dict.fromkeys(production.COUNTERS, 0)
    for row in rows:
        stats["lidos"] += 1
        work, person, role = row["id_producao"], row["id_pessoa"], row["papel"]
        if work is None or person is None:
            stats["nulos_removidos"] += 1
        elif person not in people or work not in works:
            stats["orfaos"] += 1
        else:
            if role is not None:
                stats["correcoes"] += tidy(role) != role
                role = tidy(role) or None
            stats["duplicatas" if (work, person, role) in seen else "escritos"] += 1
            seen.add((work, person, role))
    return seen, stats


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    crew = crew_lines(7)
    for name, docs in (("pessoa", PEOPLE), ("producao", WORKS), ("equipe", crew)):
        lines = [json.dumps(d, ensure_ascii=False) for d in docs] + BROKEN
        (folder / f"{name}.jsonl").write_text("\n".join(lines) + "\n", encoding="utf-8")
    return folder, crew


@pytest.fixture(scope="module")
def result(spark, landed, tmp_path_factory):
    out = tmp_path_factory.mktemp("clean")
    report = production.run(spark, str(landed[0]), str(out))
    return out, {r["dataset"]: r.asDict() for r in report.collect()}


def clean(spark, folder, name):
    docs = []
    for part in (folder / f"{name}_clean").glob("part-*"):
        docs += [json.loads(line) for line in part.read_text(encoding="utf-8").splitlines()]
    return docs


def test_people(spark, result):
    docs = clean(spark, result[0], "pessoa")
    assert sorted(docs, key=lambda d: d["id_pessoa"]) == [
        {"id_pessoa": 1, "nome": "Ana Lima"},
        {"id_pessoa": 2, "nome": "Bia Reis"},
        {"id_pessoa": 3},
        {"id_pessoa": 4},
        {"id_pessoa": 5, "nome": "Caio"},
    ]
    assert result[1]["pessoa"] == {
        "dataset": "pessoa", "lidos": 13, "escritos": 5, "duplicatas": 1, "nulos_removidos": 2,
        "titulos_nulos": 0, "correcoes": 3, "orfaos": 0, "erros_parse": 5, "ids_invalidos": 0,
    }


def test_productions(spark, result):
    docs = {d["id_producao"]: d for d in clean(spark, result[0], "producao")}
    assert docs[10] == {"id_producao": 10, "titulo": "A B", "ano": 2004, "tipo_id": 1}
    assert docs[11] == {"id_producao": 11, "ano": 1999}
    assert [docs[i].get("ano") for i in range(12, 19)] == [None, None, 1800, 2100, None, None, 2010]
    assert docs[18]["tipo_id"] == 7
    assert result[1]["producao"] == {
        "dataset": "producao", "lidos": 16, "escritos": 9, "duplicatas": 1, "nulos_removidos": 1,
        "titulos_nulos": 1, "correcoes": 9, "orfaos": 0, "erros_parse": 5, "ids_invalidos": 0,
    }


def test_crew(spark, landed, result):
    people = {d["id_pessoa"] for d in clean(spark, result[0], "pessoa")}
    works = {d["id_producao"] for d in clean(spark, result[0], "producao")}
    seen, stats = expected_crew(landed[1], people, works)
    stats["lidos"] += len(BROKEN)
    stats["erros_parse"] = len(BROKEN)
    stats["ids_invalidos"] = 0
    docs = clean(spark, result[0], "equipe")
    assert {(d["id_producao"], d["id_pessoa"], d.get("papel")) for d in docs} == seen
    assert len(docs) == len(seen)
    assert result[1]["equipe"] == {"dataset": "equipe", **stats}


def test_run_again_and_compare_sizes(spark, landed, result):
    out, first = result
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        production.run(spark, str(landed[0]), str(out))
    again = production.run(spark, str(landed[0]), str(out), mode="overwrite").collect()
    assert {r["dataset"]: r.asDict() for r in again} == first
    sizes = {r["dataset"]: r for r in production.size_comparison(spark, str(landed[0]), str(out)).collect()}
    assert set(sizes) == {"pessoa", "producao", "equipe"}
    assert sizes["equipe"]["reduction_pct"] > 50


def test_further_fields_come_from_the_first_line(spark, tmp_path):
    lines = {
        "pessoa": [{"id_pessoa": 1, "nome": "a", "uf": "GO"}, {"id_pessoa": 1, "nome": "a", "uf": "SP"}],
        "producao": [{"id_producao": 2, "titulo": "t", "dur": 90}],
        "equipe": [
            {"id_producao": 2, "id_pessoa": 1, "papel": "x ", "ordem": 9},
            {"id_producao": 2, "id_pessoa": 1, "papel": "x", "ordem": 1},
        ],
    }
    for name, docs in lines.items():
        (tmp_path / f"{name}.jsonl").write_text("\n".join(map(json.dumps, docs)))
    more = {
        "pessoa": StructType([StructField("uf", StringType())]),
        "producao": StructType([StructField("dur", LongType())]),
        "equipe": StructType([StructField("ordem", LongType())]),
    }
    production.run(spark, str(tmp_path), str(tmp_path / "out"), more_fields=more)
    assert clean(spark, tmp_path / "out", "pessoa") == [{"id_pessoa": 1, "nome": "a", "uf": "GO"}]
    assert clean(spark, tmp_path / "out", "producao") == [{"id_producao": 2, "titulo": "t", "dur": 90}]
    assert clean(spark, tmp_path / "out", "equipe") == [
        {"id_producao": 2, "id_pessoa": 1, "papel": "x", "ordem": 9}
    ]


def test_every_line_is_counted_once(result):
    for c in result[1].values():
        parts = ("escritos", "duplicatas", "nulos_removidos", "orfaos", "erros_parse", "ids_invalidos")
        assert c["lidos"] == sum(c[p] for p in parts)


def test_ids_in_other_forms_stay_and_others_are_reported(spark, tmp_path):
    people = ['{"id_pessoa": "2", "nome": "a"}', '{"id_pessoa": 3.0, "nome": "b"}', '{"id_pessoa": "x"}', '{"id_pessoa": 2.5}', "broken"]
    (tmp_path / "pessoa.jsonl").write_text("\n".join(people))
    (tmp_path / "producao.jsonl").write_text('{"id_producao": "9", "titulo": "t"}')
    (tmp_path / "equipe.jsonl").write_text('{"id_producao": 9.0, "id_pessoa": "3", "papel": "p"}')
    report = {r["dataset"]: r for r in production.run(spark, str(tmp_path), str(tmp_path / "out")).collect()}
    assert clean(spark, tmp_path / "out", "equipe") == [{"id_producao": 9, "id_pessoa": 3, "papel": "p"}]
    assert sorted(d["id_pessoa"] for d in clean(spark, tmp_path / "out", "pessoa")) == [2, 3]
    got = report["pessoa"]
    assert (got["lidos"], got["escritos"], got["erros_parse"], got["ids_invalidos"]) == (5, 2, 1, 2)
    rejects = spark.read.json(str(tmp_path / "out" / "pessoa_rejects")).collect()
    assert sorted((r["reason"], r["line"], r["copies"]) for r in rejects) == [
        ("invalid", '{"id_pessoa": "x"}', 1), ("invalid", '{"id_pessoa": 2.5}', 1), ("parse", "broken", 1)
    ]


def test_cleaning_is_idempotent(spark, result, tmp_path):
    again = tmp_path / "again"
    again.mkdir()
    for name in ("pessoa", "producao", "equipe"):
        text = "".join(
            p.read_text(encoding="utf-8") for p in (result[0] / f"{name}_clean").glob("part-*")
        )
        (again / f"{name}.jsonl").write_text(text, encoding="utf-8")
    report = production.run(spark, str(again), str(tmp_path / "out")).collect()
    for r in report:
        assert r["lidos"] == r["escritos"] == result[1][r["dataset"]]["escritos"]
        assert r["correcoes"] == r["erros_parse"] == 0
    for name in ("pessoa", "producao", "equipe"):
        first = sorted(map(str, clean(spark, result[0], name)))
        assert first == sorted(map(str, clean(spark, tmp_path / "out", name)))


def test_line_order_keeps_the_first_copy(spark, tmp_path):
    lines = [json.dumps({"id_pessoa": i % 50, "nome": f"n{i:06d}" + "x" * 200}) for i in range(20000)]
    (tmp_path / "p.jsonl").write_text("\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "262144")
    try:
        raw = read_jsonl_tolerant(spark, str(tmp_path / "p.jsonl"), PERSON_RAW)
        kept = production.clean_rows(production.people_by_key(raw)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {r["id_pessoa"]: r["nome"][:7] for r in kept} == {i: f"n{i:06d}" for i in range(50)}


def test_schemas_name_the_landed_fields():
    assert [s.fieldNames()[0] for s in (PERSON_RAW, PRODUCTION_RAW, CREW_RAW)] == [
        "id_pessoa", "id_producao", "id_producao"
    ]


def test_dashboard_questions(spark, rows):
    works = spark.createDataFrame(
        [(1, "Matrix", 1999), (2, "A matrix 2", 2003), (3, "Up", 1999), (4, None, None)],
        "id_producao long, titulo string, ano int",
    )
    assert [tuple(r) for r in production.productions_per_year(works).collect()] == [("1999", 2), ("2003", 1)]
    assert rows(production.search_titles(works, "MATRIX"), "id_producao") == [(1,), (2,)]
    crew = spark.createDataFrame([("Ator",), ("Ator",), (None,), ("Diretor",)], "papel string")
    assert [tuple(r) for r in production.common_roles(crew).collect()] == [("Ator", 2), ("Diretor", 1)]


def test_load_collection(spark, landed, tmp_path, rows):
    target = str(tmp_path / "collection")
    counts = production.load_collection(
        spark, str(landed[0] / "pessoa.jsonl"), PERSON_RAW, target, ["id_pessoa"]
    )
    assert rows(counts) == [(len(PEOPLE), len(BROKEN), 2)]
    assert readers.read_collection(spark, target).count() == len(PEOPLE)


def test_counters_come_with_the_write(spark, tmp_path):
    """One write of some of the rows counts all of them: no filter moves below the counters, no second pass is made."""
    folded = production.people_by_key(
        read_jsonl_tolerant(spark, _people(tmp_path, 40), PERSON_RAW)
    )
    want = production.quality_report(folded, "pessoa").collect()
    shown, seen = production.observed(folded, "pessoa")
    kept = production.clean_rows(shown)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter (status") < plan.index("CollectMetrics")
    kept.write.json(str(tmp_path / "clean"))
    assert production.observed_report(spark, {"pessoa": seen}).collect() == want


def _people(tmp_path, n):
    path = tmp_path / "people.jsonl"
    path.write_text("\n".join([json.dumps({"id_pessoa": i % (n // 2) or None, "nome": f" p  {i}"}) for i in range(n)] + ["{", ""]) + "\n")
    return str(path)


def test_lines_of_one_status_are_read_alone(spark, tmp_path):
    folded = production.people_by_key(read_jsonl_tolerant(spark, _people(tmp_path, 40), PERSON_RAW))
    staged = production._staged_by_status(folded, "people")
    for df, filters in ((production.clean_rows(staged), "(status#"), (production.rejected_lines(staged), "status#")):
        scan = next(x for x in df._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in x)
        assert filters in scan.split("PartitionFilters: [")[1].split("]")[0]


def test_shuffles_have_parts_by_the_size_of_the_lines(spark, tmp_path, monkeypatch):
    """More lines are more partitions, not larger ones, whatever the session's number is."""
    for name, rows in {"pessoa": PEOPLE, "producao": WORKS, "equipe": crew_lines(1) * 20}.items():
        (tmp_path / f"{name}.jsonl").write_text("\n".join(map(json.dumps, rows)) + "\n")
    monkeypatch.setattr(production, "PART_BYTES", (tmp_path / "equipe.jsonl").stat().st_size // 30, raising=False)
    seen, stage = [], production.staged

    def spy(df, name, by):
        seen.append((name, spark.conf.get("spark.sql.shuffle.partitions")))
        return stage(df, name, by)

    monkeypatch.setattr(production, "staged", spy)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    production.run(spark, str(tmp_path), str(tmp_path / "out"))
    assert len(seen) == 3 and {n for _, n in seen} == {"31"}
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
