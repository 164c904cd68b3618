"""Text parsing with quarantine (S1-S3, K5) - edge cases from FIXTURES."""

from conftest import lines_df

from shelfwise.sources import text


def _parse(spark, lines):
    p = text.parse_ratings(lines_df(spark, lines))
    good = sorted(tuple(r) for r in p.good.collect())
    bad = {r["line"]: r["reason"] for r in p.rejected.collect()}
    return good, bad


def test_well_formed_and_extra_fields_kept(spark):
    good, bad = _parse(spark, ["1,2,3.5", "5,6,7,8"])
    assert good == [(1, 2, 3.5), (5, 6, 7.0)]
    assert bad == {}


def test_blank_is_trimmed(spark):
    good, _ = _parse(spark, ["1, 2,3"])
    assert good == [(1, 2, 3.0)]


def test_rejections_have_reasons(spark):
    good, bad = _parse(spark, ["x,2,3", "1.5,2,3", "1,2", "", "7,8,NaN", "9223372036854775808,1,1", "1,2,abc", "1,2,Infinity"])
    assert good == []
    assert bad["x,2,3"] == text.BAD_ID
    assert bad["1.5,2,3"] == text.BAD_ID
    assert bad["1,2"] == text.TOO_FEW_FIELDS
    assert bad[""] == text.EMPTY_LINE
    assert bad["7,8,NaN"] == text.NOT_FINITE
    assert bad["9223372036854775808,1,1"] == text.ID_OUT_OF_RANGE
    assert bad["1,2,abc"] == text.BAD_NUMBER
    assert bad["1,2,Infinity"] == text.NOT_FINITE


def test_every_line_lands_once(spark):
    lines = ["1,2,3", "bad", "4,5,6", "7,8"]
    p = text.parse_ratings(lines_df(spark, lines))
    assert p.good.count() + p.rejected.count() == len(lines)


def test_users_and_books(spark):
    u = text.parse_users(lines_df(spark, ["3,ann,1,34,novel,X", "4,bob,m,20,a,b", "5,c,0,1"]))
    # a gender in words is a null feature of a kept user
    assert sorted(tuple(r) for r in u.good.collect()) == [(3, "ann", 1.0, 34.0, "novel", "X"), (4, "bob", None, 20.0, "a", "b")]
    assert {r["reason"] for r in u.rejected.collect()} == {text.TOO_FEW_FIELDS}
    b = text.parse_books(lines_df(spark, ["9,title,auth,,style,label", "10,t,a,4.5,s,l"]))
    rows = sorted(tuple(r) for r in b.good.collect())
    assert rows == [(9, "title", "auth", None, "style", "label"), (10, "t", "a", 4.5, "s", "l")]


def test_tokens_to_lines(spark):
    df = text.tokens_to_lines(lines_df(spark, ["1,2,3 4,5,1", "  ", "6,7,2"]))
    assert sorted(r["value"] for r in df.collect()) == ["1,2,3", "4,5,1", "6,7,2"]


def test_text_round_trip(spark, tmp_dir):
    path = f"{tmp_dir}/r"
    text.write_lines(lines_df(spark, ["1,2,3", "oops"]), path)
    p = text.read_ratings(spark, path)
    assert [tuple(r) for r in p.good.collect()] == [(1, 2, 3.0)]
    assert p.rejected.count() == 1


from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

_piece = st.one_of(
    st.one_of(st.integers(-3_000_000_000, 3_000_000_000), st.sampled_from([-(2**63), 2**63 - 1, 2**63, -(2**63) - 1])).map(str),
    st.floats(allow_nan=True, allow_infinity=True).map(repr),
    st.sampled_from(["", " ", "x", "1.5", " 7 ", "NaN", "+4", "-0"]),
)
_line = st.lists(_piece, min_size=0, max_size=5).map(",".join)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(_line, min_size=1, max_size=30))
def test_every_line_lands_in_exactly_one_side(spark, lines):
    p = text.parse_ratings(lines_df(spark, lines))
    good = p.good.collect()
    bad = p.rejected.collect()
    assert len(good) + len(bad) == len(lines)
    for r in good:
        assert -2**63 <= r["user_id"] < 2**63 and -2**63 <= r["product_id"] < 2**63
        assert r["rating"] == r["rating"] and abs(r["rating"]) != float("inf")


def test_tagged_frame_materialises_with_out_of_range_ids(spark):
    p = text.parse_ratings(lines_df(spark, ["9223372036854775808,1,1", "1,99999999999999999999,2", "3,4,5"]))
    rows = p.tagged.collect()  # every row, rejected ones included
    assert len(rows) == 3
    assert sorted(r["reason"] or "" for r in rows) == ["", text.ID_OUT_OF_RANGE, text.ID_OUT_OF_RANGE]
