"""Personal data in texts: patterns propose spans, checksums confirm them, and words nearby adjust their score.

Four base kinds (email, ip, card, phone) keep every match that passes its own check. Three more proposals are
added if their score is high enough: card numbers inside longer runs of digits (Luhn), account
numbers (mod 97 and the country's length), and national phone and social security numbers, which need a context word.

A match's place is counted, not searched: a text is split at the pattern, and the lengths of the pieces and matches
before a match give its start. The pieces also hold what stands around it. Patterns that start with a run of
characters only start where the run does (or where the last match ended) and never give characters back, so each
reads a text once, whatever it holds. Everything is a built-in expression on one row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import let

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE_KINDS = KINDS[:4]
ENOUGH = 50
CHECKED, NEAR, AGAINST = 30, 35, -30  # what a checksum, a word for it and a word against it add to a score (hundredths)
BEFORE, AFTER = 60, 30
CHUNK = 256

# The forms of the base kinds and of the added ones. The second form of a pattern means the same without
# look-behind and possessive runs.
LOCAL, DOMAIN = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
EMAIL = rf"{LOCAL}+@{DOMAIN}+(\.{DOMAIN}+)+"
EMAIL_ONCE = rf"(?:(?<!{LOCAL})|\G){LOCAL}++@{DOMAIN}++(?:\.{DOMAIN}++)++"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
IP_ONCE = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9]([\x20-]?[0-9])+"
CARD_ONCE = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
DIGITS = "[0-9]{14,}"
DIGITS_ONCE = "[0-9]{14,}+"
NATIONAL_PHONE = r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}"
IBAN = r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)"
SSN = "[0-9]{3}-[0-9]{2}-[0-9]{4}"
# Lengths of account numbers by country.
IBAN_LENGTHS = {"AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18, "FR": 27,
                "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21,
                "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SI": 19, "SK": 24, "TR": 26}
# Words near a span that speak for its kind, and words that speak against any kind.
WORDS = {"email": ("contact", "email", "mail", "write"), "ip": ("address", "host", "ip", "server"),
         "card": ("card", "credit", "debit", "mastercard", "payment", "visa"), "phone": ("call", "cell", "fax", "mobile", "phone", "tel"),
         "iban": ("account", "bank", "iban", "transfer"), "ssn": ("security", "social", "ssn", "taxpayer")}
WORDS_AGAINST = ("invoice", "isbn", "order", "sample", "serial", "tracking", "version")
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Proposal:
    """A pattern, the kind it proposes, its prior score and whether a checksum confirms it; base ones stay whatever their score."""
    name: str
    kind: str
    pattern: str
    plain: str
    prior: int
    checked: bool
    base: bool


PROPOSALS = (
    Proposal("email", "email", EMAIL_ONCE, EMAIL, 60, False, True),
    Proposal("ip", "ip", IP_ONCE, IP, 60, False, True),
    Proposal("card", "card", CARD_ONCE, CARD, 40, True, True),
    Proposal("phone", "phone", PHONE, PHONE, 60, False, True),
    Proposal("card_run", "card", DIGITS_ONCE, DIGITS, 30, True, False),
    Proposal("national_phone", "phone", NATIONAL_PHONE, NATIONAL_PHONE, 30, False, False),
    Proposal("iban", "iban", IBAN, IBAN, 30, True, False),
    Proposal("ssn", "ssn", SSN, SSN, 30, False, False),
)


def prefix_sums(values: Column) -> Column:
    """Per place of an array of longs the sum of the values before it. Chunks keep the work near linear for long arrays."""
    total = lambda a: F.aggregate(a, F.lit(0).cast("bigint"), lambda s, x: s + x)

    def offsets(v: Column, sums: Column) -> Column:
        before = F.transform(sums, lambda _, c: total(F.slice(sums, F.lit(1), c)))
        return let(before, lambda b: F.transform(v, lambda _, i: F.get(b, (i / CHUNK).cast("int")) + total(F.slice(v, i - i % CHUNK + 1, i % CHUNK))))

    def chunked(v: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.greatest(F.size(v), F.lit(1)), F.lit(CHUNK))
        return let(F.transform(firsts, lambda a: total(F.slice(v, a, F.lit(CHUNK)))), lambda sums: offsets(v, sums))

    return let(values, chunked)


MATCHES = "array<struct<value:string,start:bigint,stop:bigint,before:string,after:string,joined:boolean>>"


def matches(text: Column, pattern: str) -> Column:
    """The matches of a pattern as structs: value, start and stop (code points), what stands before and after it (within the
    piece), and whether a neighbour match joins it without a character between."""
    def located(found: Column, pieces: Column) -> Column:
        length = lambda a, i: F.char_length(F.get(a, i)).cast("bigint")
        steps = F.transform(found, lambda m, i: length(pieces, i) + F.char_length(m))

        def one(m: Column, i: Column, sums: Column) -> Column:
            start = F.get(sums, i) + length(pieces, i)
            piece, following = F.get(pieces, i), F.get(pieces, i + 1)
            joined = ((i > 0) & (piece == "")) | ((i + 1 < F.size(found)) & (following == ""))
            return F.struct(m.alias("value"), start.alias("start"), (start + F.char_length(m)).alias("stop"),
                            F.right(piece, F.lit(BEFORE)).alias("before"), F.left(following, F.lit(AFTER)).alias("after"), joined.alias("joined"))

        return let(prefix_sums(steps), lambda sums: F.transform(found, lambda m, i: one(m, i, sums)))

    def all_of(found: Column) -> Column:
        return F.when(F.size(found) == 0, F.array().cast(MATCHES)).otherwise(
            let(F.split(text, pattern), lambda pieces: located(found, pieces)).cast(MATCHES))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), all_of)


def luhn(digits: Column) -> Column:
    """Whether the check digit of a string of digits is right."""
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.char_length(digits) - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), add) % 10 == 0


def mod_97(account: Column) -> Column:
    """Whether an account number of capitals and digits leaves 1: its first four characters go to the end, letters count from 10."""
    turned = F.concat(F.substring(account, F.lit(5), F.char_length(account)), F.substring(account, F.lit(1), F.lit(4)))

    def step(rest: Column, i: Column, text: Column) -> Column:
        code = F.ascii(F.substring(text, i, F.lit(1)))
        return F.when(code < 65, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97).cast("int")

    return let(turned, lambda t: F.aggregate(F.sequence(F.lit(1), F.char_length(t)), F.lit(0), lambda r, i: step(r, i, t))) == 1


def _only_digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn_of(digits: Column) -> Column:
    return let(digits, lambda d: F.when(F.char_length(d).between(14, 19), luhn(d)).otherwise(F.lit(False)))


def _low_parts(value: Column) -> Column:
    """Whether all parts of a dotted number are 255 at most (leading zeros count for nothing)."""
    short = lambda p: F.when(F.char_length(p) <= 3, F.concat(F.lit("0"), p).cast("int") <= 255).otherwise(F.lit(False))
    return F.forall(F.split(value, r"\."), lambda p: let(F.ltrim(p, F.lit("0")), short))


def _account(m: Column) -> Column:
    """The match cut to its country's length, with its new stop; null if it is too short or goes on without a blank."""
    length = F.lit(None).cast("int")
    for country, n in sorted(IBAN_LENGTHS.items()):
        length = F.when(F.substring(m["value"], 1, 2) == country, n).otherwise(length)
    grouped = F.substring(m["value"], 5, 1) == " "

    def cut(n: Column) -> Column:
        size = n + F.when(grouped, F.floor((n - 1) / 4).cast("int")).otherwise(0)
        value = F.substring(m["value"], F.lit(1), size)
        next_one = F.substring(m["value"], size + 1, F.lit(1))
        whole = (F.char_length(m["value"]) >= size) & ((next_one == "") | (next_one == " "))
        return F.when(whole, F.struct(F.translate(value, " ", "").alias("value"), (m["start"] + size).alias("stop"), (next_one == " ").alias("apart")))

    return let(length, cut)


def _clear(m: Column, kind: str, after_too=None) -> Column:
    """Whether no letter or digit (nor a hyphen, for numbers) touches the match."""
    edge = "[A-Za-z0-9]" if kind == "iban" else "[A-Za-z0-9-]"
    ends = ~F.left(m["after"], F.lit(1)).rlike(edge)
    return ~m["joined"] & ~F.right(m["before"], F.lit(1)).rlike(edge) & (ends if after_too is None else ends | after_too)


def _confirmed(p: Proposal, m: Column) -> Column:
    """Whether a match passes the check of its proposal."""
    value = m["value"]
    if p.name == "email":
        return F.lit(True)
    if p.name == "ip":
        return _low_parts(value)
    if p.name == "card":
        return _luhn_of(_only_digits(value))
    if p.name == "card_run":
        return _clear(m, "card") & _luhn_of(value)
    if p.name == "phone":
        return F.char_length(_only_digits(value)).between(10, 15)
    if p.name == "national_phone":
        return _clear(m, "phone")
    if p.name == "ssn":
        return _clear(m, "ssn") & ~value.rlike("^(?:000|666|9)|-00-|-0000$")
    raise ValueError(p.name)


def word_pattern(words: tuple[str, ...]) -> str:
    return "(^|[^a-z])(" + "|".join(words) + ")([^a-z]|$)"


def _score(p: Proposal, m: Column) -> Column:
    around = F.translate(F.concat(m["before"], F.lit(" | "), m["after"]), CAPITALS, SMALL)
    points = lambda words, n: F.when(around.rlike(word_pattern(words)), n).otherwise(0)
    return F.lit(p.prior + (CHECKED if p.checked else 0)) + points(WORDS[p.kind], NEAR) + points(WORDS_AGAINST, AGAINST)


def _spans(text: Column, p: Proposal) -> Column:
    """start, rank (of the kind), stop and score of the proposal's confirmed matches, in order."""
    rank = F.lit(KINDS.index(p.kind))
    span = lambda m, stop: F.struct(m["start"].alias("start"), rank.alias("rank"), stop.alias("stop"), _score(p, m).alias("score"))
    if p.name == "iban":
        both = F.transform(matches(text, p.pattern), lambda m: F.struct(m.alias("m"), _account(m).alias("a")))
        good = F.filter(both, lambda x: x["a"].isNotNull() & _clear(x["m"], "iban", x["a"]["apart"]) & mod_97(x["a"]["value"]))
        return F.transform(good, lambda x: span(x["m"], x["a"]["stop"]))
    return F.transform(F.filter(matches(text, p.pattern), lambda m: _confirmed(p, m)), lambda m: span(m, m["stop"]))


def _meets(span: Column, others: Column) -> Column:
    """Whether a span meets one of other spans, which are in order and apart: a binary search for the last that starts before its end."""
    steps = F.array(*[F.lit(1 << s) for s in reversed(range(26))])
    before = F.aggregate(steps, F.lit(0), lambda at, s: F.when(F.get(others, at + s - 1)["start"] < span["stop"], at + s).otherwise(at))
    return let(before, lambda n: (n > 0) & F.coalesce(F.get(others, n - 1)["stop"] > span["start"], F.lit(False)))


def find_spans(text: Column, enough: int = ENOUGH) -> Column:
    """Struct base, added: arrays of spans (start, rank of the kind in KINDS, stop, score), each in order of start and kind.

    Starts and stops count code points; scores are hundredths. Added spans score ``enough`` or more and meet no base span.
    A null text counts as empty.
    """
    whole = F.coalesce(text, F.lit(""))
    base = [p for p in PROPOSALS if p.base]
    more = [p for p in PROPOSALS if not p.base]
    found = let(whole, lambda t: F.struct(*[_spans(t, p).alias(p.name) for p in PROPOSALS]))

    def split(x: Column) -> Column:
        added = F.filter(F.concat(*[x[p.name] for p in more]),
                         lambda s: (s["score"] >= enough) & ~_any([_meets(s, x[p.name]) for p in base]))
        return F.struct(F.sort_array(F.concat(*[x[p.name] for p in base])).alias("base"), F.sort_array(added).alias("added"))

    return let(found, split)


def _any(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def written_spans(spans: Column) -> Column:
    """``kind:start:stop`` of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"].cast("string"), s["stop"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def personal_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (all of them), n_added and scores of every row.

    Null and empty texts have no spans; repeated rows and null ids are judged row by row; other columns are left out; an
    empty table gives an empty result. Spans of one start are in order of kinds, then of their stops.
    """
    found = docs.select("doc_id", find_spans(F.col("text")).alias("_found"))
    count = lambda k: F.size(F.filter(F.col("_found.base"), lambda s: s["rank"] == KINDS.index(k))).cast("bigint").alias(f"n_{k}")
    every = F.sort_array(F.concat("_found.base", "_found.added"))
    return found.select(
        "doc_id", *[count(k) for k in BASE_KINDS], F.sha2(written_spans(F.col("_found.base")), 256).alias("base_sha256"),
        written_spans(every).alias("spans"), F.size("_found.added").cast("bigint").alias("n_added"),
        F.array_join(F.transform(every, lambda s: s["score"].cast("string")), ",").alias("scores"))


def personal_sql(enough: int = ENOUGH) -> str:
    """DuckDB SQL of ``personal_report`` over documents."""
    raw = " UNION ALL ".join(f"SELECT rid, {i} AS p, regexp_extract_all(text, '{p.plain}') AS ms, string_split_regex(text, '{p.plain}') AS ps FROM texts"
                             for i, p in enumerate(PROPOSALS))
    number = {p.name: i for i, p in enumerate(PROPOSALS)}
    digits = "regexp_replace(value, '[^0-9]', '', 'g')"
    digit = f"CAST(substr({digits}, length({digits}) - i + 1, 1) AS INTEGER)"
    luhn_sql = (f"length({digits}) BETWEEN 14 AND 19 AND list_sum(list_transform(range(1, length({digits}) + 1), lambda i: "
                f"CASE WHEN i % 2 = 1 THEN {digit} WHEN {digit} > 4 THEN 2 * {digit} - 9 ELSE 2 * {digit} END)) % 10 = 0")
    left = lambda edge: f"NOT joined AND NOT regexp_matches(right(before, 1), '{edge}')"
    clear = f"{left('[A-Za-z0-9-]')} AND NOT regexp_matches(left(after, 1), '[A-Za-z0-9-]')"
    size = "(n + CASE WHEN substr(value, 5, 1) = ' ' THEN (n - 1) // 4 ELSE 0 END)"
    lengths = " ".join(f"WHEN '{c}' THEN {n}" for c, n in sorted(IBAN_LENGTHS.items()))
    account = f"replace(substr(value, 1, {size}), ' ', '')"
    rest = (f"list_reduce(list_prepend(0, list_transform(string_split(substr({account}, 5) || substr({account}, 1, 4), ''), lambda c: ascii(c))), "
            "lambda a, c: CASE WHEN c < 65 THEN (a * 10 + c - 48) % 97 ELSE (a * 100 + c - 55) % 97 END)")
    following = f"substr(value, {size} + 1, 1)"
    good_account = (f"n IS NOT NULL AND length(value) >= {size} AND {following} IN ('', ' ') AND {left('[A-Za-z0-9]')} AND "
                    f"({following} = ' ' OR NOT regexp_matches(left(after, 1), '[A-Za-z0-9]')) AND {rest} = 1")
    checks = {
        "email": "true", "ip": "len(list_filter(string_split(value, '.'), lambda x: length(ltrim(x, '0')) > 3 OR CAST('0' || left(ltrim(x, '0'), 3) AS INTEGER) > 255)) = 0",
        "card": luhn_sql, "phone": f"length({digits}) BETWEEN 10 AND 15", "card_run": f"{clear} AND {luhn_sql}", "national_phone": clear,
        "iban": good_account, "ssn": f"{clear} AND NOT regexp_matches(value, '^(?:000|666|9)|-00-|-0000$')"}
    cases = lambda f: "CASE p " + " ".join(f"WHEN {i} THEN {f(p)}" for i, p in enumerate(PROPOSALS)) + " END"
    around = f"translate(before || ' | ' || after, '{CAPITALS}', '{SMALL}')"
    points = lambda words, n: f"CASE WHEN regexp_matches({around}, '{word_pattern(words)}') THEN {n} ELSE 0 END"
    written_form = lambda what, rows="": f"coalesce(string_agg({what}, ',' ORDER BY start, rank, stop){rows}, '')"
    span = "kind || ':' || start || ':' || stop"
    n_base = len([p for p in PROPOSALS if p.base])
    counts = ", ".join(f"count(*) FILTER (base AND kind = '{k}') AS n_{k}" for k in BASE_KINDS)
    return f"""
WITH texts AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
raw AS ({raw}),
m AS (SELECT rid, p, k, ms[k] AS value, ps[k] AS piece, ps[k + 1] AS following, (k > 1 AND ps[k] = '') OR (k < len(ms) AND ps[k + 1] = '') AS joined
    FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS k FROM raw WHERE len(ms) > 0)),
placed AS (SELECT rid, p, value, joined, right(piece, {BEFORE}) AS before, left(following, {AFTER}) AS after, CASE left(value, 2) {lengths} END AS n,
    sum(length(piece) + length(value)) OVER (PARTITION BY rid, p ORDER BY k) - length(value) AS start FROM m),
good AS (SELECT rid, p < {n_base} AS base, {cases(lambda p: f"'{p.kind}'")} AS kind, {cases(lambda p: KINDS.index(p.kind))} AS rank, start,
    start + CASE WHEN p = {number['iban']} THEN {size} ELSE length(value) END AS stop,
    {cases(lambda p: p.prior + (CHECKED if p.checked else 0))} + {cases(lambda p: points(WORDS[p.kind], NEAR))} + {points(WORDS_AGAINST, AGAINST)} AS score
    FROM placed WHERE {cases(lambda p: f"({checks[p.name]})")}),
kept AS (SELECT * FROM good WHERE base UNION ALL SELECT a.* FROM good a WHERE NOT a.base AND a.score >= {enough} AND NOT EXISTS
    (SELECT 1 FROM good b WHERE b.base AND b.rid = a.rid AND b.start < a.stop AND b.stop > a.start)),
summed AS (SELECT rid, {counts}, {written_form(span, " FILTER (base)")} AS base_spans,
    {written_form(span)} AS spans, count(*) FILTER (NOT base) AS n_added, {written_form("CAST(score AS VARCHAR)")} AS scores FROM kept GROUP BY rid)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE_KINDS)}, sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans,
    coalesce(n_added, 0) AS n_added, coalesce(scores, '') AS scores FROM texts LEFT JOIN summed USING (rid)""".strip()
