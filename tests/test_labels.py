import random
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from arrivals_mart.schemas import COUNTRY_LOOKUP, PORT_LOOKUP
from arrivals_mart.sources.files import read_csv
from arrivals_mart.sources.labels import (
    STATES,
    country_lookup,
    label_dictionary,
    line_map,
    port_lookup,
    read_label_lines,
    scanned,
    write_lookups,
)

# An invented dictionary with the edge forms of a format catalogue.
LONG_LABEL = "Q" * 5000
LABEL_TEXT = "\r\n".join(
    [
        "title 'codes of an imaginary archipelago' ;",
        "",
        "/* islands: some are sunk */",
        "  value isles",
        "   9001 =  'CORALIA'",
        "   9002 =  'PUMICE ROCK (north, and the lagoon)'   9003 =  'INVALID: SUNKEN BANK'",
        "   9004 =  'Collapsed Sandbar (not drawn)'",
        "   9005 =  'No Island Code (9005)' ;",
        f"   9006 =  '{LONG_LABEL}'",
        "   9001 =  'A LATER NAME OF CORALIA'",
        "",
        "/* harbours - with the shore's letters, such as 'ZZ'='nowhere' */",
        "  VALUE $harb",
        "   'H1A'\t=\t'SALTMOUTH, LW   '",
        "   'H2B'\t=\t'O''REEF, LW' 'H2C' = 'KELP BAY, WW'",
        "   'H3'\t\t=\t'No HARBOUR Code (H3)'",
        "   'H4 '\t=\t'GREAT COVE, OUTER MOLE, EW '",
        "   'H5D' \t=\t'SHALLOWS WW           '",
        "   'H6E'\t=\t'DRY DOCK, SW (BPS)'",
        "   'H7F'\t=\t'HIGH PIER, NW #ARPT'",
        "   'H8G'\t=\t'FAR STRAND, BEYOND, QQ'",
        "   'H9H'\t=\t'OLD QUAY, UPPER, LOWER SHORE'",
        ";",
        "",
        "/* ways to travel:",
        "   1 = rowing",
        "*/",
        "Value ways",
        "\t1 = 'Rowing'",
        "\t2 = 'Sailing' ;",
        "",
        "value shores",
        "\t'LW'='LEEWARD'",
        "\t'WW'='WINDWARD'",
        "\t'SW'='SOUTHWARD'",
        "\t'EW'='EASTWARD'",
        "\t'NW'='NORTHWARD' ;",
        "end ;",
        "",
    ]
)

EXPECTED_COUNTRIES = [
    ("9001", "A LATER NAME OF CORALIA", True),
    ("9001", "CORALIA", True),
    ("9002", "PUMICE ROCK (north, and the lagoon)", True),
    ("9003", "INVALID: SUNKEN BANK", False),
    ("9004", "Collapsed Sandbar (not drawn)", False),
    ("9005", "No Island Code (9005)", False),
    ("9006", LONG_LABEL, True),
]
EXPECTED_PORTS = [
    ("H1A", "SALTMOUTH", "LW"),
    ("H2B", "O'REEF", "LW"),
    ("H2C", "KELP BAY", "WW"),
    ("H3", "No HARBOUR Code (H3)", None),
    ("H4", "GREAT COVE, OUTER MOLE", "EW"),
    ("H5D", "SHALLOWS", "WW"),
    ("H6E", "DRY DOCK", "SW"),
    ("H7F", "HIGH PIER", "NW"),
    ("H8G", "FAR STRAND, BEYOND, QQ", None),
    ("H9H", "OLD QUAY, UPPER, LOWER SHORE", None),
]


@contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _write(tmp_path):
    p = tmp_path / "labels.txt"
    p.write_bytes(LABEL_TEXT.encode("latin-1"))
    return str(p)


def _check(labels):
    blocks = {r[0]: r[1] for r in labels.groupBy("block").count().collect()}
    assert blocks == {"isles": 7, "$harb": 10, "ways": 2, "shores": 5}
    got = sorted(
        tuple(r) for r in labels.filter("block = 'isles'").select("code", "label", "is_valid").collect()
    )
    assert got == EXPECTED_COUNTRIES
    ports = sorted(tuple(r) for r in port_lookup(labels, block="$harb", state_block="shores").collect())
    assert ports == EXPECTED_PORTS
    countries = dict(tuple(r) for r in country_lookup(labels, block="isles").collect())
    assert countries["9001"] == "CORALIA"  # the first entry of a repeated code
    assert countries["9003"] == "INVALID: SUNKEN BANK"
    valid = dict(tuple(r) for r in country_lookup(labels, block="isles", valid_only=True).collect())
    assert sorted(valid) == ["9001", "9002", "9006"]
    usable = {r.code for r in port_lookup(labels, block="$harb", state_block="shores", valid_only=True).collect()}
    assert usable == {p[0] for p in EXPECTED_PORTS} - {"H3"}


def test_label_dictionary_edge_forms(spark, tmp_path):
    _check(label_dictionary(spark, _write(tmp_path)))


def test_label_dictionary_split_across_partitions(spark, tmp_path):
    path = _write(tmp_path)
    with conf(spark, **{"spark.sql.files.maxPartitionBytes": "128", "spark.sql.files.openCostInBytes": "0"}):
        splits = read_label_lines(spark, path).select("split_start").distinct().count()
        assert splits > 3
        _check(label_dictionary(spark, path))


def test_write_lookups_produces_pipeline_inputs(spark, tmp_path):
    path = _write(tmp_path)
    staging = str(tmp_path / "staging")
    write_lookups(spark, path, staging, port_block="$harb", country_block="isles", state_block="shores")
    ports = read_csv(spark, str(tmp_path / "staging" / "port_mapping"), PORT_LOOKUP)
    countries = read_csv(spark, str(tmp_path / "staging" / "country_mapping"), COUNTRY_LOOKUP)
    assert sorted(tuple(r) for r in ports.collect()) == EXPECTED_PORTS
    assert ("9002", "PUMICE ROCK (north, and the lagoon)") in [tuple(r) for r in countries.collect()]


def test_entries_on_the_header_line_count_and_passed_over_lines_are_told(spark, tmp_path):
    path = tmp_path / "dict.txt"
    path.write_text(
        "value a 1='one' 2='two'\n 3='three' ;\nvalue $b (min=1 max=9)'X'='why' ;\nvalue c\n 4='four'\n"
        "see 5='five'\nvalue d of 6='six'\n"
    )
    with pytest.warns(UserWarning, match="^2 label entries"):
        got = label_dictionary(spark, str(path))
    assert sorted(tuple(r) for r in got.select("block", "code", "label").collect()) == [
        ("$b", "X", "why"), ("a", "1", "one"), ("a", "2", "two"), ("a", "3", "three"), ("c", "4", "four"),
    ]


SPANNING = r"""proc format library=lib ;
value a
 1 = 'A /* keep */ B'
 2 = "dq; it's" 3 = "say ""so"" twice"
/* gone:
 value y
 9 = 'old' */ 4 = 'after a comment'
 5 =
   'label on the next line'
 6
 = /* why */ 'equals on the next line'
 7 = 'two
lines, O''NEIL'
 8 = 'one''' ; value
 b (min=1
  max=40
  default=20) 1 = 'in b' ; value $c
 (max=9)
 'X' = 'y' ;
 /* ends 'open */
 'Z;' = 'z; ''value q''' "W" = 'w' 10 = ''
value d 1 = unquoted
 2 = 'two' junk 3 = 'three'
 see 4 = 'four'
"""
SPANNED = [
    ("a", "1", "A /* keep */ B"), ("a", "2", "dq; it's"), ("a", "3", 'say "so" twice'), ("a", "4", "after a comment"),
    ("a", "5", "label on the next line"), ("a", "6", "equals on the next line"), ("a", "7", "two lines, O'NEIL"),
    ("a", "8", "one'"), ("b", "1", "in b"), ("$c", "X", "y"), ("$c", "Z;", "z; 'value q'"), ("$c", "W", "w"), ("$c", "10", ""),
    ("d", "2", "two"), ("d", "3", "three"),
]


@pytest.mark.parametrize("split_bytes", [None, 32, 7])
def test_what_spans_lines_and_splits(spark, tmp_path, split_bytes):
    path = tmp_path / "dict.txt"
    path.write_bytes(SPANNING.replace("\n", "\r\n").encode())
    # the label without quotes and the entry that its line does not begin with
    with conf(spark, **{"spark.sql.files.openCostInBytes": "0"}), pytest.warns(UserWarning, match="^2 label entries"):
        got = label_dictionary(spark, str(path), split_bytes=split_bytes)
        assert [tuple(r) for r in got.orderBy("place").select("block", "code", "label").collect()] == SPANNED


def test_small_blocks_of_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("arrivals_mart.sources.labels.LINES_PER_BLOCK", 2)
    path = tmp_path / "dict.txt"
    path.write_text(SPANNING)
    with pytest.warns(UserWarning, match="^2 label entries"):
        got = label_dictionary(spark, str(path))
    assert [tuple(r) for r in got.orderBy("place").select("block", "code", "label").collect()] == SPANNED


def test_a_file_that_ends_inside_quotes_is_told(spark, tmp_path):
    (tmp_path / "one.txt").write_text("value a\n 1 = 'x'\n 2 = 'never closed\n 3 = ...")
    (tmp_path / "two.txt").write_text("value b\n 1 = 'y' /* */\n")
    with pytest.warns(UserWarning, match="label files end inside|not taken") as told:
        got = label_dictionary(spark, str(tmp_path))
    assert sorted(tuple(r) for r in got.select("block", "code", "label").collect()) == [("a", "1", "x"), ("b", "1", "y")]
    assert any(str(w.message).startswith("1 label files end inside") for w in told)


def _plain_lexer(state, text):
    closers = {"C": "*/", "S": "'", "D": '"', "P": ")"}
    i = 0
    while i < len(text):
        if state != "T":
            at = text.find(closers[state], i)
            if at < 0:
                return state
            i, state = at + len(closers[state]), "T"
        elif text.startswith("/*", i):
            i, state = i + 2, "C"
        elif text[i] in "'\"":
            i, state = i + 1, "S" if text[i] == "'" else "D"
        elif text.startswith(" value n(", i):
            i, state = i + 9, "P"
        else:
            i += 1
    return state


def test_line_maps_equal_a_plain_lexer(spark):
    rng = random.Random(4)
    pieces = ["'", '"', "/*", "*/", "/", "*", "x", " value n(", ")", "(", " ", "é"]
    lines = ["".join(rng.choices(pieces, k=rng.randint(0, 12))) for _ in range(600)]
    got = spark.createDataFrame([(x,) for x in lines], "line string").select("line", line_map(F.col("line")).alias("m")).collect()
    for r in got:
        assert r.m[:5] == "".join(_plain_lexer(s, r.line) for s in "TCSDP"), r.line


@pytest.mark.parametrize("line,states", [
    ("value", "TV"), ("Value  ", "TV"), (" x VALUE $nm", "TN"), ("value n (a=1", "TP"), ("", "VV"), ("$nm ", "VN"),
    (" b (min=1", "VP"), (" b (min=1) 1", "VT"), ("  ", "NN"), ("(max=9", "NP"), ("(max=9)", "NT"), ("myvalue", "TT"),
    ("1 = 'x' ; value", "TV"), ("'value", "TS"), ("'value'", "TT"), ("$value", "TT"),
])
def test_headers_that_go_on(spark, line, states):
    m = spark.createDataFrame([(line,)], "line string").select(line_map(F.col("line"))).first()[0]
    assert m[STATES.index(states[0])] == states[1]


def test_scanned_maps_are_composed_in_order(spark):
    rng = random.Random(5)
    rows = [(g, i, "".join(rng.choices(STATES, k=len(STATES)))) for g in range(4) for i in range(40)]
    df = spark.createDataFrame(rows, "g int, i int, map string").repartition(5)
    each, whole = scanned(df, ["g"], ["i"], "test-scan")
    now = {}
    want = {}
    for g, i, m in rows:
        want[g, i] = now.get(g, STATES)
        now[g] = "".join(m[STATES.index(s)] for s in want[g, i])
    assert {(r.g, r.i): r.before for r in each.collect()} == want
    assert {r.g: r.map for r in whole.collect()} == now
