import base64

import pytest
from pyspark.sql import functions as F

from marquetry import schemas
from marquetry.operators.ordering import top_k
from marquetry.plans import catalogue, education, outbreaks, salary
from marquetry.sources import payloads, readers, sizes, writers


def test_education(spark, tmp_path, rows):
    (tmp_path / "wide.csv").write_text(
        '"Localidade";"Variável";"2020";"2021";"2022"\n'
        f'"Aqui";"{education.TEACHERS}";"4.000";"3.998";"927"\n'
        f'"Aqui";"{education.CLASSROOMS}";"2.000";"1.000";"0"\n'
        f'"Ali";"{education.TEACHERS}";"10";"12";"15"\n'
        f'"Ali";"{education.CLASSROOMS}";"8";"8";"16"\n',
        encoding="utf-8",
    )
    wide = readers.read_csv_text(spark, str(tmp_path / "wide.csv"), sep=";")
    kpis = education.kpi_table(education.long_table(wide, ["2020", "2021", "2022"]))
    got = {(r["Localidade"], r["Ano"]): tuple(r)[2:] for r in kpis.collect()}
    assert got[("Aqui", 2020)] == (4000.0, 2000.0, 2.0, 0.0, 0.0, 0.0)
    assert got[("Aqui", 2021)] == (3998.0, 1000.0, 4.0, -0.05, -50.0, 49.95)
    assert got[("Aqui", 2022)] == (927.0, 0.0, 0.0, -76.81, -100.0, 23.19)
    assert got[("Ali", 2022)] == (15.0, 16.0, 0.94, 25.0, 100.0, -75.0)
    last = education.latest_summary(kpis).collect()[0]
    assert tuple(last) == (2022, 942.0, 16.0, 0.47, -25.9)
    one = education.of_locality(kpis, "Ali")
    assert [r["Ano"] for r in one.collect()] == [2020, 2021, 2022]
    writers.write_csv_ptbr(kpis, str(tmp_path / "out"))
    back = readers.read_csv_ptbr(spark, str(tmp_path / "out"), ["Docentes", "KPI_1_Docente_por_Sala"])
    assert ("Ali", 15.0, 0.94) in rows(back, "Localidade", "Docentes", "KPI_1_Docente_por_Sala")


def test_salaries(spark, tmp_path, rows):
    (tmp_path / "s.csv").write_text(
        "UF   ; Salário inicial ; Região\nMS   ;13.007,12; Centro-Oeste\nMA   ;8.452,03; Nordeste\n"
        "GO   ;5.000,00; Centro-Oeste\nPI   ;5.000,00; Nordeste\n",
        encoding="utf-8-sig",
    )
    df = salary.read_salaries(spark, str(tmp_path / "s.csv"))
    assert df.columns == ["UF", "Salário inicial", "Região", "salario"]
    assert salary.highest_state(df).collect()[0]["UF"] == "MS"
    assert salary.lowest_state(df).collect()[0]["UF"] == "GO"
    assert salary.position_of(df, "MA").collect()[0]["position"] == 2
    assert salary.mean_salary(df).collect()[0]["mean"] == 7864.79
    assert [tuple(r) for r in salary.mean_by_region(df).collect()] == [("Centro-Oeste", 9003.56), ("Nordeste", 6726.02)]
    assert rows(salary.highest_by_region(df), "UF") == [("MA",), ("MS",)]
    assert rows(salary.lowest_by_region(df), "UF") == [("GO",), ("PI",)]
    assert rows(salary.best_and_worst_region(df), "Região", "which") == [("Centro-Oeste", "highest"), ("Nordeste", "lowest")]


@pytest.fixture
def events(spark):
    rows = [
        ("Peste", "Bactéria", 1346, 1353, "Ásia", 3, 75, 50.0, 10.0, True, "Medieval", 30.0),
        ("Gripe", "Vírus", 1918, 1920, "EUA", 6, 50, 2.5, 90.0, False, "Moderna", 33.0),
        ("Cólera", "Bactéria", 1817, 1824, "Índia", 3, 1, 3.0, 90.0, True, "Moderna", 5.0),
        ("Nova", "Vírus", 2019, None, None, 6, 7, 1.0, 20.0, None, "Atual", 80.0),
    ]
    return spark.createDataFrame(
        rows,
        "Nome_Evento string, Tipo_Patogeno string, Ano_Inicio int, Ano_Fim int, Regiao_Origem string, "
        "Continentes_Afetados int, Mortes_Estimadas long, Taxa_Fatalidade double, "
        "Impacto_Economico_Bilhao_USD double, Avanco_Medico boolean, Era string, Porcentagem_Disseminacao double",
    )


def test_outbreaks(events, rows):
    assert [r[0] for r in outbreaks.deadliest(events, 2).collect()] == ["Peste", "Gripe"]
    assert [r[0] for r in outbreaks.most_widespread(events, 1).collect()] == ["Nova"]
    assert rows(outbreaks.costliest(events), "Nome_Evento") == [("Cólera",), ("Gripe",)]
    assert rows(outbreaks.above_mean_fatality(events), "Nome_Evento") == [("Peste",)]
    assert [tuple(r) for r in outbreaks.spread_and_deaths_by_pathogen(events).collect()] == [
        ("Bactéria", 17.5, 76), ("Vírus", 56.5, 57)
    ]
    assert outbreaks.deaths_by_continents(events).collect()[0]["Nome_Evento"] == "Peste"
    assert rows(outbreaks.impact_by_era(events)) == [("Medieval", True, 10.0), ("Moderna", False, 90.0), ("Moderna", True, 90.0)]
    assert len(outbreaks.fatality_points(events).columns) == 4


def test_smallest_salaries_are_not_the_largest(spark):
    jobs = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0)], "job_title string, salary double")
    assert [r[0] for r in top_k(jobs, "salary", "job_title", 2, ascending=True).collect()] == ["a", "b"]
    assert [r[0] for r in top_k(jobs, "salary", "job_title", 2).collect()] == ["c", "b"]


def test_payloads(spark, tmp_path, rows):
    people = tmp_path / "people.json"
    people.write_text(
        '{"results": [{"name": {"first": "Ana", "last": "Sá"}, "dob": {"age": 29}, "email": "a", "phone": "1"},'
        ' {"name": {"first": "Bia", "last": "Reis"}, "dob": {"age": 30}, "email": "b", "phone": "2"}]}\n{"results": []}\n'
    )
    docs = payloads.employee_documents(payloads.read_payloads(spark, str(people), schemas.PERSON_PAYLOAD))
    assert rows(docs) == [
        ("Ana Sá", 29, "a", "1", "Desenvolvedor", 7000, "TI"),
        ("Bia Reis", 30, "b", "2", "Gerente", 12000, "TI"),
    ]
    artist = tmp_path / "artist.json"
    artist.write_text(
        '{\n "name": "X", "artists": {"items": [{"id": "1"}]}, "albums": [\n'
        '  {"id": "a", "name": "One", "release_date": "2000-01-01", "tracks": [{"name": "t1"}, {"name": "t2"}]},\n'
        '  {"id": "b", "name": "Two", "tracks": [{"name": "t3"}]}, {"id": "c", "name": "None", "tracks": []}]}'
    )
    lost = tmp_path / "lost.json"
    lost.write_text('{"name": "Y", "artists": {"items": []}, "albums": []}')
    landed = payloads.read_payloads(spark, [str(artist), str(lost)], schemas.ARTIST_PAYLOAD, whole_files=True)
    tracks = payloads.track_rows(landed)
    assert rows(tracks) == [
        ("t1", "X", "One", "2000-01-01"), ("t2", "X", "One", "2000-01-01"), ("t3", "X", "Two", "N/A")
    ]
    assert rows(payloads.extraction_counts(tracks)) == [("X", 3)]


def test_catalogue_jobs(spark, tmp_path, rows):
    landed = tmp_path / "artists.jsonl"
    landed.write_text(
        '{"name": "X", "artists": {"items": [{"id": "1"}]}, "albums": [{"id": "a", "name": "One",'
        ' "tracks": [{"name": "t,1"}]}]}\n{"name": "Y", "artists": {"items": []}, "albums": []}\n'
    )
    counts = catalogue.export_tracks(spark, str(landed), str(tmp_path / "csv"))
    assert rows(counts) == [("X", 1), ("Y", 0)]
    back = readers.read_csv(spark, str(tmp_path / "csv"), schemas.TRACK)
    assert rows(back) == [("t,1", "X", "One", "N/A")]
    people = tmp_path / "people.json"
    people.write_text('{"results": [{"name": {"first": "A", "last": "B"}, "dob": {"age": 40}}]}')
    target = str(tmp_path / "funcionarios")
    for _ in range(2):
        catalogue.load_employees(spark, str(people), target, whole_files=True)
    found = readers.find(readers.read_collection(spark, target), {"cargo": "Gerente"})
    assert rows(found, "nome", "salario") == [("A B", 12000)]


def test_csv_with_byte_order_mark(spark, tmp_path, rows):
    df = spark.createDataFrame([("Canção", "X"), ('a,"b"', "Y")], "musica string, artista string")
    writers.write_csv(df, str(tmp_path / "m"), bom=True)
    part = next(p for p in (tmp_path / "m").glob("part-*") if p.stat().st_size > 3)
    assert part.read_bytes()[:3] == b"\xef\xbb\xbf"
    assert rows(readers.read_csv(spark, str(tmp_path / "m"), df.schema)) == rows(df)
    assert readers.read_csv_text(spark, str(tmp_path / "m")).columns == ["musica", "artista"]


def test_binary_files(spark, tmp_path, rows):
    content = bytes(range(256)) * 5
    (tmp_path / "one.jpg").write_bytes(content)
    (tmp_path / "two.jpg").write_bytes(b"x")
    images = readers.binary_table(spark, str(tmp_path))
    assert ("two.jpg", base64.b64encode(b"x").decode()) in rows(images)
    ordered = images.withColumn("id", F.when(F.col("nome") == "one.jpg", 2).otherwise(1))
    latest = readers.latest_binary(ordered).collect()[0]
    assert (latest["nome"], bytes(latest["content"])) == ("one.jpg", content)


def test_backup_round_trip(spark, tmp_path, rows):
    tables = {
        "transactions": spark.createDataFrame([("b", 2.0, None), ("a", 1.0, "r")], "id string, value double, recurring_id string"),
        "goals": spark.createDataFrame([("Lazer", 5.0)], schemas.GOAL),
    }
    writers.write_backup(str(tmp_path / "b"), tables, {"transactions": ["id"]})
    back = readers.read_backup(spark, str(tmp_path / "b"), {n: d.schema for n, d in tables.items()})
    assert {n: rows(d) for n, d in back.items()} == {n: rows(d) for n, d in tables.items()}


def test_null_fields_in_json_lines(spark, tmp_path):
    df = spark.createDataFrame([(1, None)], "i int, s string").coalesce(1)
    writers.write_jsonl(df, str(tmp_path / "drop"))
    writers.write_jsonl(df, str(tmp_path / "keep"), keep_nulls=True)
    assert spark.read.text(str(tmp_path / "drop")).collect()[0][0] == '{"i":1}'
    assert spark.read.text(str(tmp_path / "keep")).collect()[0][0] == '{"i":1,"s":null}'


def test_literal_frames_and_find(spark, rows):
    cols = readers.frame_from_columns(spark, {"n": ["A", "B"], "i": [1, 2]}, "n string, i int")
    assert rows(cols) == [("A", 1), ("B", 2)]
    schema = cols.schema
    recs = readers.frame_from_records(spark, [{"n": "A"}, {"i": 5}], schema)
    assert rows(recs) == sorted([("A", None), (None, 5)], key=repr)
    assert rows(readers.find(cols, {"n": "B"})) == [("B", 2)]
    assert rows(readers.find(cols, key="i", limit=1)) == [("A", 1)]
    with pytest.raises(ValueError):
        readers.frame_from_columns(spark, {"n": ["A"], "i": [1, 2]}, schema)


def test_size_report(spark, tmp_path):
    for name, n in (("raw", 2_000_000), ("clean", 500_000)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "f.txt").write_bytes(b"x" * n)
        (tmp_path / name / "_SUCCESS").write_bytes(b"")
    raw, clean = {"d": str(tmp_path / "raw"), "only": str(tmp_path / "raw")}, {"d": str(tmp_path / "clean")}
    got = sizes.size_report(spark, raw, clean).collect()
    assert [tuple(r) for r in got] == [("d", 1.9073, 0.4768, 75.0)]


def test_tolerant_lines(spark, tmp_path, rows):
    (tmp_path / "x.jsonl").write_bytes(
        b'{"id_pessoa": 1, "nome": "a"}\t \r\n\n{"id_pessoa": "x"}\nnull\n{"id_pessoa": 2} {"id'
    )
    df = readers.read_jsonl_tolerant(spark, str(tmp_path / "x.jsonl"), schemas.PERSON_RAW)
    good, bad = readers.split_bad(df)
    assert rows(good, "id_pessoa", "nome") == [(1, "a")]
    assert rows(df.filter(F.col(readers.INVALID).isNotNull()), readers.INVALID) == [('{"id_pessoa": "x"}',)]
    assert rows(bad) == sorted(
        [("",), ('{"id_pessoa": "x"}',), ("null",), ('{"id_pessoa": 2} {"id',)], key=repr
    )


@pytest.mark.parametrize(
    "line, person",
    [
        ('{"id_pessoa": 3}', 3),
        ('{"id_pessoa": 3, "nome": "a } b"}', 3),
        ('{"id_pessoa": "3"}', 3),
        ('{"id_pessoa": 3.0}', 3),
        ('{"id_pessoa": "3.0"}', 3),
        ('{"id_pessoa": 3, "other": {"x": [1, {}]}} ', 3),
        ('{"id_pessoa": 3} {"id_pessoa": 4}', None),
        ('{"id_pessoa": 3},{"id_pessoa": 4}', None),
        ('{"id_pessoa": 3}}', None),
        ('{"id_pessoa": 3}]}', None),
        ("{'id_pessoa': 3}", None),
        ("5", None),
        (None, None),
    ],
)
def test_one_object_per_line(spark, line, person):
    frame = spark.createDataFrame([(line,)], "value string")
    row = readers.parse_lines(frame, schemas.PERSON_RAW).collect()[0]
    if person is None:
        assert row[readers.CORRUPT] == (line or "")
    else:
        assert (row["id_pessoa"], row[readers.CORRUPT]) == (person, None)
