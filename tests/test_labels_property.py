from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from arrivals_mart.sources.labels import label_dictionary

from .test_labels import conf

_label = st.text(alphabet="ABC xyz,'#()-", min_size=1, max_size=20).filter(lambda s: s.strip() != "")
_quoted_code = st.text(alphabet="ABC123", min_size=1, max_size=3)
_numeric_code = st.integers(0, 999).map(str)
_block = st.tuples(
    st.sampled_from(["cntyl", "$prtl", "modl"]),
    st.booleans(),  # numeric codes?
    st.lists(st.tuples(st.one_of(_quoted_code, _numeric_code), _label), min_size=1, max_size=8),
)


def _render(blocks):
    lines = ["libname library 'x' ;", "/* header comment */"]
    expected = []
    for name, numeric, entries in blocks:
        lines.append(f"  value {name}")
        for i, (code, label) in enumerate(entries):
            shown = code if numeric and code.isdigit() else f"'{code}'"
            sep = " =  " if numeric else "\t=\t"
            end = " ;" if i == len(entries) - 1 else ""
            lines.append(f"   {shown}{sep}'{label.replace(chr(39), chr(39) * 2)}'{end}")
            expected.append((name, code.rstrip(), label.rstrip()))
        lines.append("")
    return "\r\n".join(lines) + "\r\n", expected


@settings(max_examples=6, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(blocks=st.lists(_block, min_size=1, max_size=4))
def test_label_parser_matches_rendered_entries(spark, tmp_path_factory, blocks):
    text, expected = _render(blocks)
    path = tmp_path_factory.mktemp("labels") / "dict.txt"
    path.write_bytes(text.encode("latin-1"))
    with conf(spark, **{"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "0"}):
        got = sorted(tuple(r) for r in label_dictionary(spark, str(path)).select("block", "code", "label").collect())
    assert got == sorted(expected)
