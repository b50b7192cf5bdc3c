"""Translated patterns against an engine built on RE2."""

import duckdb
import pytest

from telemetry_lake.functions.dialect import DialectError, portable
from telemetry_lake.operators import pattern_violations

TAKEN = [
    ";", "--", r"/\*", "DROP|SELECT", "a.b", "(?s)a.b", "a$", r"a\z", r"\s", r"a\S", r"[\s-]", r"\bDROP\b", r"O\B", "a{", "a{,3}",
    "{}", "a{2,3}?b", "[]a]", "[^]a ]", "[a&&b]", "[a[b]", "[[:alpha:]_]+[[:^digit:]]", "[[:word:]]é", "(?i)K", "(?i)straSSe", "(?i:s)x",
    r"\pN", r"\p{Lu}\PL", r"\p{Greek}", r"\p{^Greek}é", r"\x{41}\x42", r"\v", r"\Qa.b\E+", r"\Q[x", "(?P<n>a)+b",
    r"^\A-", r"(a|b(c|d)*)+\.", "é+", r"[^\n]\t", r"\d{3}\w\W",
]
REFUSED = {
    "(?=a)": "look-ahead", "a(?!b)": "look-ahead", "(?<=a)b": "look-behind", "(?<!a)b": "look-behind", "(?>a)": "atomic",
    r"(a)\1": "back-reference", r"(?P<n>a)\k<n>": "back-reference", "a*+": "possessive", "a++b": "possessive", "a{2}{3}": "repeated",
    r"\h": "escape", r"\R": "escape", r"a\Z": "escape", r"\G": "escape", r"\C": "escape", r"\u0041": "escape", "(?<m>x)": "named group", "(?m)^a": "flag m",
    "(?x)a b": "flag x", "a{1001}": "1000", "*a": "nothing", "(a": "not closed", "a)": "not opened", "[a": "class", r"\p{IsGreek}": "property",
    r"[\S]": "in a class", "a\\": "backslash",
}
TEXTS = [
    "", "a", "b", "ab", "a\nb", "a\rb", "a\u0085b", "a\n", "a;b--c", "/* x */", "xDROPy", "a DROP b", "éDROP", "SELECT", "\x0b", " ", "a{",
    "a{,3}", "{}", "aab", "aaab", "]", "&", "[", "_", "_é", "K", "k", "K", "STRASSE", "straße", "ſx", "٣", "5", "Aa1", "A1", "α", "αé", "AB",
    "a.b", "a.bb", "axb", "[x", "xz", "-x", "cbcd.", "éé", "x\t", "123a-", "\n", "Q 7",
]


def test_translated_patterns_find_the_same(spark):
    con = duckdb.connect()
    texts = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id int, t string").coalesce(1)
    got = texts.selectExpr("id", *[f"rlike(t, r\"{portable(p)}\") AS p{n}" if '"' not in p else "" for n, p in enumerate(TAKEN)])
    for row in got.collect():
        for n, p in enumerate(TAKEN):
            want = con.execute("SELECT regexp_matches(?, ?)", [TEXTS[row.id], p]).fetchone()[0]
            assert row[n + 1] == want, (p, portable(p), TEXTS[row.id])


@pytest.mark.parametrize("pattern", REFUSED)
def test_refused_by_name(pattern):
    with pytest.raises(DialectError, match=REFUSED[pattern]):
        portable(pattern)


def test_violations_read_as_re2(spark):
    rows = spark.createDataFrame([("A\x0bB",), ("A B",), (None,)], "vin string")
    found = pattern_violations(rows, ["vin"], [r"A\sB$"], dialect="re2").collect()
    assert [r.vin for r in found] == ["A B"]
    with pytest.raises(ValueError, match="dialect"):
        pattern_violations(rows, ["vin"], ["a"], dialect="pcre")
