"""DuckDB SQL for SimHash fingerprints and their groups: XXH64 from its public specification, step by step on whole columns.

SQL has neither XXH64 nor sums modulo 2 ** 64, so products are taken in 128 bits and cut.  A shingle is its bytes in hexadecimal; the steps
of the digest are one CTE each, and those that repeat for every eight bytes are reductions of lists.
"""

from __future__ import annotations

#: The primes of XXH64.
P1, P2, P3, P4, P5 = 11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261
_CUT = (1 << 64) - 1


def _cut(x: str) -> str:
    return f"(({x}) & {_CUT}::UHUGEINT)"


def _times(x: str, factor: int, plus: int = 0) -> str:
    return _cut(f"{x} * {factor}::UHUGEINT + {plus}::UHUGEINT")


def _turned(x: str, by: int) -> str:
    return _cut(f"({x} << {by}) + ({x} >> {64 - by})")


def _let(name: str, value: str, then: str) -> str:
    return f"list_transform([{value}], lambda {name}: {then})[1]"


def _round(acc: str, lane: str) -> str:
    return _let("t", _cut(f"{acc} + {lane} * {P2}::UHUGEINT"), _times(_turned("t", 31), P1))


def _number(at: str, size: int) -> str:
    """The little-endian number of ``size`` bytes from the byte ``at`` of the hexadecimal text x."""
    return "CAST('0x' || " + " || ".join(f"substr(x, 2 * ({at}) + {2 * k + 1}, 2)" for k in reversed(range(size))) + " AS UBIGINT)::UHUGEINT"


def simhash_sql(words: int, seed: int, max_bits: int) -> str:
    """(doc_id, fingerprint, component_id) of the view ``documents``, whose doc_id is a key."""
    starts = [(seed + P1 + P2) & _CUT, (seed + P2) & _CUT, seed, (seed - P1) & _CUT]
    lanes = ", ".join(
        f"list_reduce(lanes[{k + 1}:n // 32 * 4:4], lambda a, l: {_round('a', 'l')}, {start}::UHUGEINT) AS v{k}" for k, start in enumerate(starts)
    )
    merged = _times(f"xor(a, {_round('0::UHUGEINT', 'l')})", P1, P4)
    turned = " + ".join(_turned(f"v{k}", by) for k, by in enumerate((1, 7, 12, 18)))
    by_eight = _let("u", f"xor(a, {_round('0::UHUGEINT', 'l')})", _times(_turned("u", 27), P1, P4))
    by_four = _let("u", f"xor(h, {_times('four', P1)})", _times(_turned("u", 23), P2, P3))
    by_one = _let("u", f"xor(a, {_times('l', P5)})", _times(_turned("u", 11), P1))
    bits = " + ".join(f"CASE WHEN 2 * sum(c * ((h >> {b}) & 1)) > sum(c) THEN {1 << b}::UBIGINT ELSE 0::UBIGINT END" for b in range(64))
    return rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, s, count(*) AS c FROM (
    SELECT doc_id, unnest([array_to_string(w[i:i + least(len(w), {words}) - 1], ' ') for i in range(1, len(w) - least(len(w), {words}) + 2)]) AS s
    FROM d WHERE len(w) > 0
  ) GROUP BY doc_id, s
), hexed AS (
  SELECT s, hex(encode(s)) AS x, octet_length(encode(s)) AS n FROM (SELECT DISTINCT s FROM s)
), laned AS (
  SELECT s, x, n, [{_number("8 * i", 8)} for i in range(0, n // 8)] AS lanes FROM hexed
), striped AS (
  SELECT s, x, n, lanes, {lanes} FROM laned
), begun AS (
  SELECT s, x, n, lanes, {_cut(f'''n::UHUGEINT + CASE WHEN n < 32 THEN {(seed + P5) & _CUT}::UHUGEINT
    ELSE list_reduce([v0, v1, v2, v3], lambda a, l: {merged}, {_cut(turned)}) END''')} AS h FROM striped
), eights AS (
  SELECT s, x, n, list_reduce(lanes[n // 32 * 4 + 1:n // 8], lambda a, l: {by_eight}, h) AS h FROM begun
), fours AS (
  SELECT s, x, n, CASE WHEN n % 8 < 4 THEN h ELSE {by_four} END AS h
  FROM (SELECT s, x, n, h, CASE WHEN n % 8 < 4 THEN 0::UHUGEINT ELSE {_number("n // 8 * 8", 4)} END AS four FROM eights)
), ones AS (
  SELECT s, list_reduce([{_number("i", 1)} for i in range(n // 4 * 4, n)], lambda a, l: {by_one}, h) AS h FROM fours
), mixed AS (
  SELECT s, {_times("xor(h, h >> 33)", P2)} AS h FROM ones
), again AS (
  SELECT s, {_times("xor(h, h >> 29)", P3)} AS h FROM mixed
), digests AS (
  SELECT s, xor(h, h >> 32)::UBIGINT AS h FROM again
), set_bits AS (
  SELECT doc_id, {bits} AS f FROM s JOIN digests USING (s) GROUP BY doc_id
), own AS (
  SELECT doc_id, coalesce(f, 0)::UBIGINT AS f FROM d LEFT JOIN set_bits USING (doc_id)
), heads AS (
  SELECT f, min(doc_id) AS least FROM own GROUP BY f
), links AS MATERIALIZED (
  SELECT a.f AS a, b.f AS b FROM heads a JOIN heads b ON a.f <> b.f AND bit_count(xor(a.f, b.f)) <= {max_bits}
), reach AS (
  SELECT f AS a, f AS b FROM heads
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT doc_id, format('{{:016x}}', f) AS fingerprint, component_id
FROM own JOIN (SELECT a AS f, min(least) AS component_id FROM reach JOIN heads ON heads.f = reach.b GROUP BY a) USING (f)
"""
