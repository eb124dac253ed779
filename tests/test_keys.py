"""Keys compare without case or trailing blanks (T1): folded once at load, plain equality after it."""

import datetime as dt

import pytest

from carecast import rules
from carecast.operators import reshape, slots
from carecast.params import Params
from carecast.plans import demand, visits
from carecast.sources import schemas

DAY, AT = dt.date(2024, 1, 9), dt.datetime(2024, 1, 9, 9, 5)
P = Params(as_of=dt.datetime(2024, 2, 1))


def table(spark, schema, *rows):
    return schemas.conform(spark.createDataFrame(list(rows), schema), schema)


def visit_table(spark, *rows):
    units = table(spark, schemas.ORG_UNIT, ("u", "xmapri", "T", "A", "c "), ("V", "XMAPRI ", "t", "a ", "C"))
    raw = table(spark, schemas.VISIT_RAW, *[(e, 7, DAY, AT, code, 1, unit, "N", 1) for e, code, unit in rows])
    return visits.classify_visits(raw, units, P)


def queue(spark, rut="r7", centre="c  "):
    return table(spark, schemas.QUEUE_LOG, (centre, rut, 1, DAY, AT, AT, "x", "box_atencion", 10.0, AT, "A", 1, "t0 ", "atencion"))


def test_units_meet_and_copies_are_one(spark):
    got = visit_table(spark, (1, "Consulta Urgenc", "U "), (1, "CONSULTA URGENC  ", "u"), (2, "consulta urgenc", "v")).collect()
    assert sorted(r["episodio"] for r in got) == [1, 2]
    assert {(r["cl_mov_desc"], r["territorio"], r["agencia"], r["centro"], r["uo_medica"]) for r in got} == {
        ("Consulta Urgenc", "T", "A", "C", "XMAPRI")}


def test_unlisted_movements_are_one_spelling(spark):
    got = visit_table(spark, (1, "odd Code ", "u"), (1, "ODD CODE", "u"), (2, None, "u")).collect()
    assert sorted((r["episodio"], r["cl_mov_desc"]) for r in got) == [(1, "ODD CODE"), (2, None)]


def test_patients_meet_their_visits(spark):
    party = table(spark, schemas.PARTY, ("R7 ", 7))
    v = visit_table(spark, (1, "Consulta Urgenc", "u"))
    rows = demand.timed_visits(queue(spark), party, v, P).collect()
    assert [(r["centro"], r["rut_paciente"], r["tipo_atencion"], r["n_pares"]) for r in rows] == [("C", "R7", "T0", 1)]
    first = slots.first_attention(queue(spark, rut="R7"), party, v).collect()
    assert [(r["centro"], r["ingreso"]) for r in first] == [("C", 1)]


def test_a_centre_with_a_queue_gets_no_synthetic_rows(spark):
    v = visit_table(spark, (1, "Consulta Urgenc", "u"))
    assert slots.synthetic_attention(v, queue(spark).select("centro").distinct()).count() == 0
    assert slots.synthetic_attention(v, queue(spark, centre="d").select("centro").distinct()).count() == 1


def test_capacity_of_a_centre(spark):
    party = table(spark, schemas.PARTY, ("R7 ", 7))
    staff = table(spark, schemas.CAPACITY, ("c ", rules.STAFF_ROLE.upper() + " ", rules.APPROVED.lower(), 2.0))
    rows = demand.demand_vs_capacity(queue(spark), party, visit_table(spark, (1, "Consulta Urgenc", "u")), staff, P).collect()
    assert [(r["centro"], r["oferta"]) for r in rows] == [("C", 2.0)]


def test_hours_meet_weekdays_and_centres(spark):
    wide = schemas.fold_centres(spark.createDataFrame([("MARTES ", "09:00:00", 1)], "diasem string, mediahora string, `c` int"))
    grid = slots.slot_grid(spark.createDataFrame([(DAY,)], "fecha date"), wide).collect()
    assert [(r["centro"], r["diasem"]) for r in grid] == [("C", "Martes")]
    assert reshape.unpivot_hours(wide).first()["centro"] == "C"


def test_folding_again_changes_nothing(spark):
    once = queue(spark)
    assert schemas.fold_keys(once).collect() == once.collect() and schemas.fold_keys(once).columns == once.columns


def spelled(spark, schema, column, *values):
    """Rows of a table, alike but for the spelling of one column, not folded."""
    filler = {"string": "x", "bigint": 1, "int": 1, "double": 1.0, "date": DAY, "timestamp_ntz": AT}
    row = [filler[f.dataType.simpleString().split(" ")[0]] for f in schema.fields]
    at = schema.fieldNames().index(column)
    return spark.createDataFrame([(*row[:at], v, *row[at + 1:]) for v in values], schemas.plain(schema))


CASES = [(name, f.name) for name, schema in schemas.DOMAIN.items() for f in schema.fields if f.dataType == schemas.TEXT]


@pytest.mark.parametrize(("table_name", "column"), CASES)
def test_every_text_column_groups_as_its_collation_does(spark, table_name, column):
    schema = schemas.DOMAIN[table_name]
    known = schemas.LISTED_COLUMNS.get(column, ["Ñandú Ábc"])[0]
    values = [known, known.upper() + "  ", known.lower(), "otro", "Otro ", " otro", None]
    df = spelled(spark, schema, column, *values)
    want = sorted(r["count"] for r in df.groupBy(df[column].cast(schemas.TEXT)).count().collect())
    for given in (df, df.withColumn(column, df[column].cast(schemas.TEXT))):
        folded = schemas.conform(given, schema)
        assert sorted(r["count"] for r in folded.groupBy(column).count().collect()) == want == [1, 1, 2, 3]
        assert dict(folded.dtypes)[column] == "string"
    assert schemas.check(df, schema) is df


def test_first_ticket_counts_all_spellings(spark):
    row = ("c", "r7", 1, DAY, AT, AT, "Médico", "box_atencion", 10.0, AT, "A", 1, "t0", "atencion")

    def with_(**kw):
        return tuple(kw.get(f, v) for f, v in zip(schemas.QUEUE_LOG.fieldNames(), row, strict=True))

    rows = [row, with_(estado="BOX_ATENCION ", cargo="MÉDICO", fila="a  "), with_(rut_paciente="R7 ")]
    for declared in (schemas.QUEUE_LOG, schemas.plain(schemas.QUEUE_LOG)):
        got = slots.first_tickets(spark.createDataFrame(rows, declared)).collect()  # not folded by the caller
        assert [(r["n_q"], r["rut_paciente"], r["estado"], r["fila"]) for r in got] == [(3, "R7", "box_atencion", "A")]


def test_keys_stay_marked_and_are_not_folded_twice(spark, tmp_path):
    once = queue(spark)
    assert schemas.fold_keys(once) is once and schemas.fold_keys(once.where("ticket = 1").select("centro")).columns == ["centro"]
    once.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    counted = stored.groupBy("centro").count()
    assert schemas.fold_keys(stored) is stored and schemas.fold_keys(counted) is counted


def test_results_are_written_as_their_table_spells_them(spark):
    units = spark.createDataFrame([("u", "m", "Metro ", "a", "Viña del Mar"), ("v", "m", "METRO", "a", "viña del mar "), ("w", "m", None, "a", "b")],
                                  schemas.plain(schemas.ORG_UNIT))
    names = schemas.spellings(units, ["territorio_m", "centro_m"])
    folded = schemas.conform(units, schemas.ORG_UNIT).groupBy("territorio_m", "centro_m").count()
    shown = schemas.respelled(folded, names, {"territorio_m": "territorio_m", "centro_m": "centro_m"}).collect()
    assert {tuple(r) for r in shown} == {("METRO", "Viña del Mar", 2), (None, "b", 1)}
