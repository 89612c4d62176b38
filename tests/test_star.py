import re
import sys
from dataclasses import asdict, replace

import pytest
from helpers import parquet_files, plan_of, planned, rows
from pyspark.sql import functions as F

from arrivals.__main__ import main
from arrivals.operators import DuplicateKey
from arrivals.plans import ArrivalDimensions, StarInputs, conform_arrivals, load_star, read_arrivals, store_arrivals
from arrivals.plans import arrivals as arrivals_plan
from arrivals.plans.arrivals import MODE_LAYOUT, STATE_LAYOUT
from arrivals.plans.mappings import BadCodeList
from arrivals.schemas import AIRPORTS, ARRIVALS, COUNTRIES, DEMOGRAPHICS, FACTS, US_PORTS, US_STATES, SchemaMismatch, check_schema
from arrivals.sinks import months
from arrivals.sources import by_files, read_facts, read_facts_untyped, read_stored

BASE = {
    "i94yr": 2016.0,
    "i94mon": 4.0,
    "i94cit": 41.0,
    "i94res": 42.0,
    "i94port": "AAA",
    "arrdate": 20566.0,
    "i94mode": 1.0,
    "i94addr": "QQ",
    "depdate": 20573.0,
    "i94bir": 30.0,
    "i94visa": 2.0,
    "dtadfile": "20160422",
    "visapost": "VPO",
    "occup": "OCC",
    "entdepa": "G",
    "entdepd": "O",
    "entdepu": "U",
    "matflag": "M",
    "biryear": 1986.0,
    "dtaddto": "10212016",
    "insnum": "INS",
    "airline": "ZZ",
    "admnum": 123456789.0,
    "fltno": "00100",
    "visatype": "B2",
}
CONFORMED = (
    2016.0, 4.0, 41.0, 42.0, "AAA", "2016-04-22", "Foot", "QQ", 20573.0, 30.0, "Fun", "20160422", "VPO", "OCC", "G",
    "O", "U", "M", 1986.0, "10212016", "INS", "ZZ", 123456789.0, "00100", "B2",
)


def facts(spark, *changes):
    return spark.createDataFrame([tuple({**BASE, **c}.values()) for c in changes], FACTS)


@pytest.fixture(scope="module")
def dims(spark):
    return ArrivalDimensions.of(
        us_state=spark.createDataFrame([("QQ", "QUUX"), ("99", "Elsewhere")], "state_code string, state string"),
        visa=spark.createDataFrame([(1, "Work"), (2, "Fun")], "visa_code bigint, visa string"),
        mode=spark.createDataFrame([(1, "Foot"), (9, "Not reported")], "mode_code bigint, mode string"),
    )


def test_all_columns(spark, dims):
    conformed = conform_arrivals(facts(spark, {}), dims)
    check_schema(conformed, ARRIVALS)
    assert rows(conformed) == [CONFORMED]


def test_misses_take_defaults_and_no_row_is_lost(spark, dims):
    raw = facts(
        spark,
        {"admnum": 1.0, "i94mode": None, "i94addr": None, "i94visa": None, "arrdate": None},
        {"admnum": 2.0, "i94mode": 7.0, "i94addr": "XX", "i94visa": 8.0, "arrdate": 0.0},
        {"admnum": 3.0, "i94mode": 9.0, "i94addr": "99", "i94visa": 1.0, "arrdate": 20566.9},
        {"admnum": 3.0, "i94mode": 9.0, "i94addr": "99", "i94visa": 1.0, "arrdate": 20566.9},
    )
    picked = conform_arrivals(raw, dims).select(
        "admission_number", "arrival_mode", "us_state", "visa_type_code", "arrival_date"
    )
    assert rows(picked) == [
        (1.0, "Not reported", "99", "Other", None),
        (2.0, "Not reported", "99", "Other", None),
        (3.0, "Not reported", "99", "Work", "2016-04-22"),
        (3.0, "Not reported", "99", "Work", "2016-04-22"),
    ]


def test_departure_day_on_request(spark, dims):
    conformed = conform_arrivals(facts(spark, {}), dims, departure_day=True)
    assert conformed.columns == ARRIVALS.names + ["departure_day"]
    assert conformed.first()["departure_day"] == "2016-04-29"


def test_ambiguous_code_list_is_rejected(spark):
    visa = spark.createDataFrame([(1, "Work"), (1, "Fun")], "visa_code bigint, visa string")
    state = spark.createDataFrame([("QQ", "QUUX")], "state_code string, state string")
    mode = spark.createDataFrame([(1, "Foot")], "mode_code bigint, mode string")
    with pytest.raises(DuplicateKey, match="visa_code"):
        ArrivalDimensions.of(state, visa, mode)


def test_plan_is_one_stage_without_python(spark, dims, tmp_path):
    path = str(tmp_path / "facts")
    facts(spark, {}).withColumn("surplus", F.lit(1)).write.parquet(path)
    conformed = conform_arrivals(read_facts(spark, path), dims)
    plan = plan_of(conformed)
    assert plan.count("BroadcastHashJoin") % 3 == 0
    assert "hashpartitioning" not in plan
    assert "Python" not in plan
    assert "surplus" not in plan
    pruned = planned(conform_arrivals(read_facts(spark, path), dims).select("year", "arrival_mode"))
    assert "ReadSchema: struct<i94yr:double,i94mode:double,i94addr:string,i94visa:double>" in pruned


def test_untyped_csv(spark, dims, tmp_path):
    path = tmp_path / "facts.csv"
    names = ["cicid", *reversed(BASE), "count", "gender"]
    values = ["7", *reversed([str(v) for v in BASE.values()]), "1.0", "F"]
    bad = ["8", *reversed([str(v) if n not in ("i94visa", "arrdate") else "x" for n, v in BASE.items()]), "1.0", ""]
    path.write_text("\n".join(",".join(line) for line in (names, values, bad)) + "\n")
    raw = read_facts_untyped(spark, str(path))
    check_schema(raw, FACTS)
    broken = list(CONFORMED)
    broken[5], broken[10] = None, "Other"
    assert rows(conform_arrivals(raw, dims)) == rows(spark.createDataFrame([CONFORMED, tuple(broken)], ARRIVALS))


def test_typed_csv_binds_by_position(spark, tmp_path):
    path = str(tmp_path / "facts.csv")
    facts(spark, {}, {"i94port": None}).write.csv(path, header=True)
    assert rows(read_facts(spark, path, "csv")) == rows(facts(spark, {}, {"i94port": None}))


def test_both_layouts_hold_every_row(spark, dims, tmp_path):
    raw = facts(
        spark,
        *[
            {
                "admnum": float(i),
                "i94port": [None, "060", "BBB"][i % 3],
                "i94addr": ["QQ", "XX"][i % 2],
                "i94mon": i % 2 + 1.0,
            }
            for i in range(30)
        ],
    )
    conformed = conform_arrivals(raw, dims)
    assert store_arrivals(conformed, str(tmp_path / "out")) == {"rows": 30}
    for suffix, layout in (("_us_state", STATE_LAYOUT), ("_arrival_mode", MODE_LAYOUT)):
        path = str(tmp_path / "out") + suffix
        assert rows(read_stored(spark, path, ARRIVALS)) == rows(conformed)
        parts = str(parquet_files(path)[0].parent.relative_to(path)).split("/")
        assert [p.split("=")[0] for p in parts] == layout
    assert len(parquet_files(str(tmp_path / "out_us_state"))) == 2


def inputs(spark, folder):
    folder.mkdir()
    text = {
        "countries": ["   41 =  'FREEDONIA'", "    0  =  'INVALID: NOWHERE'"],
        "us_states": ["\t'QQ'='QUUX' ", "\t'99'='Elsewhere'"],
        "us_ports": ["   'AAA'\t=\t'TOWN, ZZ   '", "   '060'\t=\t'HAMLET'", ";"],
        "visas": ["   1 = Work", "   2 = Fun"],
        "modes": ["\t1 = 'Foot'", "\t9 = 'Not reported'"],
        "airports": [
            "ident,t,n,e,c,ic,ir,m,g,i,l,xy",
            'X1,small_airport,"Field, north",12,NA,US,US-KS,Town,KX1,AAA,BBB,"1.5, -2.5"',
            'X1,small_airport,"Field, north",12,NA,US,US-KS,Town,KX1,AAA,BBB,"1.5, -2.5"',
            'X2,heliport,Other,,NA,CA,CA-ON,,KX2,CCC,,"3, 4"',
        ],
        "demographics": [
            "a;b;c;d;e;f;g;h;i;j;k;l",
            "Ury;Kansas;33.5;10;11;21;1;2;2.5;KS;Red;7",
            "Ury;Kansas;33.5;10;11;21;1;2;2.5;KS;Red;7",
            "Ury;;33.5;10;11;21;1;2;2.5;KS;Red;7",
        ],
    }
    for name, lines in text.items():
        (folder / name).write_text("\n".join(lines) + "\n")
    facts(spark, {}, {"i94port": "060", "i94addr": None}).write.parquet(str(folder / "facts"))
    return StarInputs(**{name: str(folder / name) for name in [*text, "facts"]})


def test_whole_load(spark, tmp_path):
    source = inputs(spark, tmp_path / "in")
    target = str(tmp_path / "out")
    for _ in range(2):
        assert rows(load_star(spark, source, target)) == [
            ("arrival dates", 2, 2),
            ("countries", 2, 2),
            ("immigration_data", 2, 2),
            ("mode lookups", 2, 2),
            ("modes", 2, 2),
            ("state lookups", 2, 1),
            ("typed facts", 2, 2),
            ("us_airports", 2, 2),
            ("us_airports lines", 3, 3),
            ("us_cities_demographics", 3, 1),
            ("us_cities_demographics lines", 3, 3),
            ("us_ports", 3, 2),
            ("us_states", 2, 2),
            ("visa lookups", 2, 2),
            ("visas", 2, 2),
        ]
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == [
        "countries",
        "immigration_data_arrival_mode",
        "immigration_data_us_state",
        "us_airports",
        "us_cities_demographics",
        "us_ports",
        "us_states",
    ]
    expected = {
        "countries": (COUNTRIES, [(0, "Other"), (41, "FREEDONIA")]),
        "us_states": (US_STATES, [("99", "Elsewhere"), ("QQ", "QUUX ")]),
        "us_ports": (US_PORTS, [("060", "HAMLET", None), ("AAA", "TOWN", "ZZ")]),
        "us_airports": (
            AIRPORTS,
            [
                ("X1", "small_airport", "Field, north", "12", "US", "KS", "Town", "KX1", code, 1.5, -2.5)
                for code in ("AAA", "BBB")
            ],
        ),
        "us_cities_demographics": (
            DEMOGRAPHICS,
            [("Ury", "Kansas", 33.5, "10", "11", 21, 1, 2, 2.5, "KS", "Red", 7)],
        ),
    }
    for name, (schema, content) in expected.items():
        assert rows(read_stored(spark, f"{target}/{name}", schema)) == content
    other = CONFORMED[:4] + ("060",) + CONFORMED[5:7] + ("99",) + CONFORMED[8:]
    for layout in ("us_state", "arrival_mode"):
        stored = read_stored(spark, f"{target}/immigration_data_{layout}", ARRIVALS)
        assert rows(stored) == rows(spark.createDataFrame([CONFORMED, other], ARRIVALS))


def test_months_can_be_added(spark, tmp_path):
    april = inputs(spark, tmp_path / "in")
    may = replace(april, facts=str(tmp_path / "may"))
    facts(spark, {"i94mon": 5.0}).write.parquet(may.facts)
    target = str(tmp_path / "out")
    corrected = replace(april, facts=str(tmp_path / "corrected"))
    facts(spark, {"i94mon": 5.0, "i94port": "NEW"}, {"i94mon": 5.0, "i94port": "NEW"}).write.parquet(corrected.facts)
    for source, stored_rows in ((april, [(4.0, 2)]), (may, [(4.0, 2), (5.0, 1)]), (may, [(4.0, 2), (5.0, 1)]), (corrected, [(4.0, 2), (5.0, 2)])):
        load_star(spark, source, target, replace_arrivals="months")
        for layout in ("us_state", "arrival_mode"):
            stored = read_arrivals(spark, target, f"_{layout}")
            assert rows(stored.groupBy("month").count()) == stored_rows
    assert rows(stored.filter("month = 5").select("port").distinct()) == [("NEW",)]


def test_bad_inputs_are_refused(spark, tmp_path):
    good = inputs(spark, tmp_path / "in")
    lacking = replace(good, facts=str(tmp_path / "lacking"))
    facts(spark, {}).drop("i94visa").write.parquet(lacking.facts)
    with pytest.raises(SchemaMismatch):
        load_star(spark, lacking, str(tmp_path / "out"))
    for text in ("1=Business\n", "\n;\n"):
        listed = tmp_path / f"visas{len(text)}.txt"
        listed.write_text(text)
        with pytest.raises(BadCodeList):
            load_star(spark, replace(good, visas=str(listed)), str(tmp_path / "out"))


def test_second_header_order_fails(spark, tmp_path):
    facts(spark, {}).write.csv(str(tmp_path / "csv"), header=True)
    one = facts(spark, {})
    one.select(*reversed(one.columns)).write.csv(str(tmp_path / "csv"), header=True, mode="append")
    with pytest.raises(Exception, match="header"):
        read_facts_untyped(spark, str(tmp_path / "csv")).collect()


def test_command_line(spark, tmp_path, monkeypatch, capsys):
    source = inputs(spark, tmp_path / "in")
    facts_csv = str(tmp_path / "facts.csv")
    read_facts(spark, source.facts).withColumn("count", F.lit(1)).write.csv(facts_csv, header=True)
    options = asdict(replace(source, facts=facts_csv, facts_format="csv")) | {"output": str(tmp_path / "out")}
    arguments = [word for name, value in options.items() for word in ("--" + name.replace("_", "-"), value)]
    monkeypatch.setattr(sys, "argv", ["arrivals", *arguments])
    main()
    assert re.search(r"\|immigration_data +\|2 +\|2 +\|", capsys.readouterr().out)
    stored = read_stored(spark, str(tmp_path / "out" / "immigration_data_us_state"), ARRIVALS)
    assert CONFORMED in rows(stored)


def test_parts_by_files(spark, tmp_path):
    path = str(tmp_path / "the facts")
    facts(spark, *[{"admnum": float(i)} for i in range(9)]).repartition(3).write.parquet(f"{path}/a b=1")
    facts(spark, {"admnum": 9.0}, {"admnum": None}).coalesce(1).write.parquet(f"{path}/a b=2")
    every = read_facts(spark, path, faulty="bad")
    sizes = [p.stat().st_size for p in parquet_files(path)]
    assert len(sizes) == 4
    for most, n in ((1, 4), (max(sizes) * 2, 2), (sum(sizes), 1)):
        parts = by_files(every, path, most)
        assert len(parts) == n
        assert rows(parts[0].unionByName(parts[-1]) if n == 2 else every) == rows(every)
        assert sum(p.count() for p in parts) == 11
        for part in parts if n > 1 else []:
            part.collect()
            scan = part._jdf.queryExecution().executedPlan().collectLeaves().head()
            assert scan.metrics().apply("numFiles").value() == 4 // n


@pytest.mark.parametrize(("how", "kind"), [("all", "csv"), ("months", "parquet")])
def test_facts_are_stored_in_turns(spark, tmp_path, monkeypatch, how, kind):
    changes = [{"admnum": float(i), "i94mon": i % 2 + 1.0, "i94addr": ["QQ", "XX", None][i % 3], "i94port": [None, "060"][i % 2]} for i in range(12)]
    source = replace(inputs(spark, tmp_path / "in"), facts=str(tmp_path / "facts"), facts_format=kind)
    facts(spark, *changes, *changes[:2]).repartition(4).write.format(kind).option("header", True).save(source.facts)
    written = []
    for module in (arrivals_plan, months):
        write = module.write_counted
        monkeypatch.setattr(module, "write_counted", lambda df, *rest, write=write: written.append((c := write(df, *rest))["rows"]) or c)
    once, turns = str(tmp_path / "once"), str(tmp_path / "turns")
    report = rows(load_star(spark, source, once, how))
    assert written == [14, 14]
    # Twice: the second load replaces the first one.
    for _ in range(2):
        written.clear()
        assert rows(load_star(spark, source, turns, how, turn_bytes=1)) == report
        assert len(written) == 8
        assert sum(written) == 28
        assert max(written) < 14
    read = read_arrivals if how == "months" else lambda s, path, layout: read_stored(s, f"{path}/immigration_data{layout}", ARRIVALS)
    for layout in ("_us_state", "_arrival_mode"):
        stored = rows(read(spark, turns, layout))
        assert len(stored) == 14
        assert stored == rows(read(spark, once, layout))
    assert len(list((tmp_path / "turns").rglob("immigration_data*/**/_SUCCESS"))) == (5 if how == "months" else 2)


def test_a_load_that_dies_between_turns_leaves_no_whole_dataset(spark, dims, tmp_path, monkeypatch):
    conformed = conform_arrivals(facts(spark, {}, {"admnum": 2.0}), dims)
    write = arrivals_plan.write_counted

    def killed(df, path, keys, metrics, hidden, replaced, more):
        if not more:
            raise RuntimeError("killed")
        return write(df, path, keys, metrics, hidden, replaced, more)

    monkeypatch.setattr(arrivals_plan, "write_counted", killed)
    with pytest.raises(RuntimeError, match="killed"):
        store_arrivals([conformed.filter("admission_number = 2"), conformed.filter("admission_number <> 2")], str(tmp_path / "out"))
    assert not list(tmp_path.rglob("_SUCCESS"))
