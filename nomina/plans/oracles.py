"""The registered queries once more, as plain SQL over the given tables.

Written for clarity, not speed: searches compare every token with every term, edit
distances are table-filling loops. Fixed word lists and letter tables are shared with the
library; no logic is.
"""

from __future__ import annotations

from nomina.functions import markup, text
from nomina.operators.pairs import SCORED
from nomina.operators.tune import random_trials

WS = text.WHITESPACE
W = text.WORD
LATIN_1_UPPER_HALF = "".join(map(chr, range(128, 256)))


def q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


# --- Expressions ---------------------------------------------------------------------


def strip(x: str) -> str:
    return f"trim({x}, {q(WS)})"


def eliminated(x: str, pattern: str) -> str:
    return f"regexp_replace({strip(f'regexp_replace({x}, {q(pattern)}, {q(" ")}, {q("g")})')}, {q(f'[{WS}]{{2,}}')}, '', 'g')"


def normalized(x: str) -> str:
    out = x
    for word in text.LEGAL_FORM_WORDS:
        out = f"replace({out}, CASE WHEN contains({x}, {q(word)}) THEN {q(word)} ELSE chr(1) END, '')"
    out = strip(out)
    out = strip(f"regexp_replace({out}, {q(text.SUFFIX_PATTERN)}, '', 'g')")
    out = eliminated(out, r"\p{Nd}+")
    out = eliminated(out, f"[^{W}]+")
    singles = "".join(text.SINGLE_LETTERS)
    out = f"translate({out}, {q(singles)}, {q(''.join(text.SINGLE_LETTERS[c] for c in singles))})"
    for letter, latin in text.MULTI_LETTERS.items():
        out = f"replace({out}, {q(letter)}, {q(latin)})"
    return f"lower({out})"


def capitalized(x: str) -> str:
    return f"upper(substr({x}, 1, 1)) || lower(substr({x}, 2))"


def words(x: str) -> str:
    return f"list_filter(string_split_regex({strip(x)}, {q(f'[{WS}]+')}), lambda t: t <> '')"


def index_terms(x: str) -> str:
    return f"regexp_extract_all(lower({x}), {q(rf"[{W}]+(?:[.'][{W}]+)*")})"


def processed(x: str) -> str:
    kept = f"translate({x}, {q(LATIN_1_UPPER_HALF)}, '')"
    return strip(f"lower(regexp_replace({kept}, {q(f'[^{W}]')}, ' ', 'g'))")


def unescaped(x: str) -> str:
    for entity, char in (("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&apos;", "'"), ("&amp;", "&")):
        x = f"replace({x}, {q(entity)}, {q(char)})"
    return x


def misspelt(x: str) -> str:
    ws = f"string_split({x}, ' ')"
    sizes = f"list_transform({ws}, lambda w: length(w))"
    at = f"list_position({sizes}, list_max({sizes}))"
    return (
        f"array_to_string(list_transform({ws}, lambda w, i: "
        f"CASE WHEN i = {at} THEN substr(w, 1, 1) || substr(w, 3) ELSE w END), ' ')"
    )


def host(x: str) -> str:
    return f"regexp_extract({x}, '^[a-z]+://([^/]+)', 1)"


def r6(x: str) -> str:
    return f"round({x}, 6)"


# --- Inputs -----------------------------------------------------------------------------

TITLES = f"""titles AS (
  SELECT page_id, url, {unescaped("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")} AS title FROM pages)"""

COMPANY = f"""company AS (
  SELECT page_id AS doc_id, {capitalized("title")} AS company_name, url AS company_url, '' AS query_string,
         lower(title) AS normalized_name FROM titles)"""

QUERY_NAMES = f"""query_names AS (SELECT page_id AS query_id, {misspelt("lower(title)")} AS query FROM titles)"""


def _decorated(key: str, name: str) -> str:
    return f"""CASE {key} % 6 WHEN 0 THEN {name} || ', LLC' WHEN 1 THEN '"' || {name} || '", LTD'
      WHEN 2 THEN 'ООО "' || {name} || '"' WHEN 3 THEN {name} || ' GmbH' WHEN 4 THEN {name} || ' 123 групп' ELSE {name} END"""


LEGAL_NAMES = f"""legal_names AS (
  SELECT 's' || s_suppkey AS id, {_decorated("s_suppkey", "s_name")} AS name FROM supplier
  UNION ALL SELECT 'c' || c_custkey, {_decorated("c_custkey", "c_name")} FROM customer
  UNION ALL SELECT 'p' || page_id, title FROM titles)"""

NAME_PAIRS = f"""name_pairs AS (
  SELECT 3 * t.page_id AS pair_id, t.title AS name_1, n.title AS name_2,
         CAST({host("t.url")} = {host("n.url")} AS INTEGER) AS is_duplicate
  FROM titles t JOIN titles n ON n.page_id = t.page_id + 1
  UNION ALL SELECT 3 * page_id + 1, title, {misspelt("title")} || ', LLC', 1 FROM titles
  UNION ALL SELECT 3 * p.p_partkey + 2, p.p_name, n.p_name,
         CAST(regexp_extract(p.p_name, '[^ ]+$') = regexp_extract(n.p_name, '[^ ]+$') AS INTEGER)
  FROM part p JOIN part n ON n.p_partkey = p.p_partkey + 1)"""

MIXED_QUERIES = """mixed_queries AS (
  SELECT 2 * query_id AS query_id, query FROM query_names
  UNION ALL SELECT 2 * s_suppkey + 1, lower(s_name) FROM supplier)"""

CANDIDATE_PAGES = """candidate_pages AS (
  SELECT 2 * s_suppkey + 1 AS query_id, 1 AS rank, p.url FROM supplier JOIN pages p ON p.page_id = s_suppkey
  UNION ALL SELECT 2 * s_suppkey + 1, 2, p.url FROM supplier JOIN pages p ON p.page_id = s_suppkey + 1)"""


def with_(ctes: list[str], select: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(ctes) + "\n" + select


# --- Similarities -------------------------------------------------------------------------


def lcs(need: str) -> list[str]:
    """``lcs(a, b, m)`` for the distinct non-empty string pairs of ``need(a, b)``, up to 62 characters on the shorter side.

    One bit per character of the shorter string, carried through the longer one.
    """
    return [
        f"""lcs_in AS (SELECT a, b, CASE WHEN length(a) <= length(b) THEN a ELSE b END AS p,
             CASE WHEN length(a) <= length(b) THEN b ELSE a END AS t
           FROM (SELECT DISTINCT a, b FROM {need} WHERE a <> '' AND b <> ''))""",
        """lcs_masks AS (SELECT a, b, length(p) AS n, (1::BIGINT << length(p)) - 1 AS ones,
             list_transform(range(1, length(t) + 1), lambda j: CAST(list_sum(list_transform(range(length(p)),
               lambda i: CASE WHEN substr(p, i + 1, 1) = substr(t, j, 1) THEN 1::BIGINT << i ELSE 0 END)) AS BIGINT)) AS masks
           FROM lcs_in)""",
        """lcs AS (SELECT a, b, n - bit_count(list_reduce(masks,
             lambda v, x: ((v + (v & x)) | (v - (v & x))) & ones, ones)) AS m FROM lcs_masks)""",
    ]


def ratio(a: str, b: str, m: str) -> str:
    return f"CASE WHEN {a} = {b} THEN 100 WHEN {a} = '' OR {b} = '' THEN 0 ELSE CAST(round_even(100.0::DOUBLE * (2.0::DOUBLE * {m} / (length({a}) + length({b}))), 0) AS INTEGER) END"


def token_parts(source: str, keys: str) -> list[str]:
    """``token_parts``: processed texts of ``source(keys, name_1, name_2)``, their sorted tokens and token sets."""
    return [
        f"""processed AS (SELECT {keys}, name_1, name_2, {processed("name_1")} AS p1, {processed("name_2")} AS p2 FROM {source})""",
        f"""tokenized AS (SELECT *, {words("p1")} AS w1, {words("p2")} AS w2 FROM processed)""",
        """token_sets AS (SELECT *, array_to_string(list_sort(w1), ' ') AS s1, array_to_string(list_sort(w2), ' ') AS s2,
             array_to_string(list_sort(list_distinct(list_filter(w1, lambda x: list_contains(w2, x)))), ' ') AS common,
             array_to_string(list_sort(list_distinct(list_filter(w1, lambda x: NOT list_contains(w2, x)))), ' ') AS only1,
             array_to_string(list_sort(list_distinct(list_filter(w2, lambda x: NOT list_contains(w1, x)))), ' ') AS only2
           FROM tokenized)""",
        """token_parts AS (SELECT *, trim(common || ' ' || only1) AS c1, trim(common || ' ' || only2) AS c2 FROM token_sets)""",
    ]


def token_set_scores(source: str) -> list[str]:
    """``token_set(name_1, name_2, token_set_ratio)`` for the distinct pairs of ``source(name_1, name_2)``."""
    return [
        f"ts_pairs AS (SELECT DISTINCT name_1, name_2 FROM {source})",
        *token_parts("ts_pairs", "1 AS one"),
        """ts_need AS (SELECT common AS a, c1 AS b FROM token_parts UNION SELECT common, c2 FROM token_parts
           UNION SELECT c1, c2 FROM token_parts)""",
        *lcs("ts_need"),
        f"ts_ratio AS (SELECT n.a, n.b, {ratio('n.a', 'n.b', 'l.m')} AS r FROM ts_need n LEFT JOIN lcs l ON l.a = n.a AND l.b = n.b)",
        """token_set AS (SELECT name_1, name_2, CASE WHEN p1 = '' OR p2 = '' THEN 0 ELSE greatest(x.r, y.r, z.r) END AS token_set_ratio
           FROM token_parts t JOIN ts_ratio x ON x.a = common AND x.b = c1
           JOIN ts_ratio y ON y.a = common AND y.b = c2 JOIN ts_ratio z ON z.a = c1 AND z.b = c2)""",
    ]


LEVENSHTEIN = """list_reduce(list_transform(range(1, length(name_1) + 1), lambda i: [i]),
    lambda above, e: list_reduce(list_transform(range(1, length(name_2) + 1), lambda j: [j]),
      lambda row, f: list_append(row, least(row[len(row)] + 1, above[f[1] + 1] + 1,
        above[f[1]] + CASE WHEN substr(name_1, e[1], 1) = substr(name_2, f[1], 1) THEN 0 ELSE 1 END)), [e[1]]),
    range(0, length(name_2) + 1))[length(name_2) + 1]"""

# Ratios of all pairs: kind of comparison and whether it is partial.
_KINDS = [
    ("ratio", "name_1", "name_2", False), ("partial", "name_1", "name_2", True), ("sort", "s1", "s2", False),
    ("set1", "common", "c1", False), ("set2", "common", "c2", False), ("set3", "c1", "c2", False),
    ("base", "p1", "p2", False), ("pbase", "p1", "p2", True), ("psort", "s1", "s2", True),
    ("pset1", "common", "c1", True), ("pset2", "common", "c2", True), ("pset3", "c1", "c2", True),
]

PAIR_FEATURES = [
    TITLES,
    NAME_PAIRS,
    "distinct_pairs AS (SELECT DISTINCT name_1, name_2 FROM name_pairs)",
    *token_parts("distinct_pairs", "row_number() OVER () AS no"),
    "compared AS ("
    + "\n UNION ALL ".join(
        f"SELECT no, '{kind}' AS kind, {str(partial).lower()} AS partial, {a} AS x, {b} AS y FROM token_parts"
        for kind, a, b, partial in _KINDS
    )
    + ")",
    """oriented AS (SELECT no, kind, partial, CASE WHEN length(x) <= length(y) THEN x ELSE y END AS a,
         CASE WHEN length(x) <= length(y) THEN y ELSE x END AS y FROM compared)""",
    """windows AS (SELECT no, kind, partial, a, y, CASE WHEN partial THEN
         unnest(CASE WHEN a = '' THEN [y] ELSE list_transform(range(1, length(y) - length(a) + 2), lambda i: substr(y, i, length(a))) END) ELSE y END AS b
       FROM oriented WHERE partial UNION ALL SELECT no, kind, partial, a, y, y FROM oriented WHERE NOT partial)""",
    *lcs("windows"),
    f"""scores AS (SELECT no, kind, max(CASE WHEN w.a = w.y THEN 100 ELSE {ratio("w.a", "w.b", "l.m")} END) AS r
       FROM windows w LEFT JOIN lcs l ON l.a = w.a AND l.b = w.b GROUP BY no, kind)""",
    """wide AS (SELECT no, """
    + ", ".join(f"max(r) FILTER (WHERE kind = '{k}') AS r_{k}" for k, *_ in _KINDS)
    + " FROM scores GROUP BY no)",
    f"""blended AS (SELECT t.*, w.* EXCLUDE (no), length(p1) = 0 OR length(p2) = 0 AS blank,
         CASE WHEN p1 = '' OR p2 = '' THEN 0 ELSE greatest(r_set1, r_set2, r_set3) END AS token_set_ratio,
         greatest(r_pset1, r_pset2, r_pset3) AS p_set,
         greatest(length(p1), length(p2)) / greatest(least(length(p1), length(p2)), 1)::DOUBLE AS spread
       FROM token_parts t JOIN wide w ON w.no = t.no)""",
    f"""features AS (SELECT name_1, name_2, {LEVENSHTEIN} AS levenshtein, r_ratio AS ratio, r_partial AS partial_ratio,
         r_sort AS token_sort_ratio, token_set_ratio,
         CASE WHEN blank THEN 0 WHEN spread < 1.5 THEN CAST(round_even(greatest(r_base, r_sort * 0.95::DOUBLE, token_set_ratio * 0.95::DOUBLE), 0) AS INTEGER)
           ELSE CAST(round_even(greatest(r_base, r_pbase * scale, r_psort * 0.95::DOUBLE * scale, p_set * 0.95::DOUBLE * scale), 0) AS INTEGER) END AS wratio,
         (len(list_filter(n1, lambda x: list_contains(n2, x))) + len(list_filter(n2, lambda x: list_contains(n1, x))))::DOUBLE
           / nullif(len(n1) + len(n2), 0) AS subs_ratio
       FROM (SELECT *, CASE WHEN spread > 8 THEN 0.6::DOUBLE ELSE 0.9::DOUBLE END AS scale, {words("name_1")} AS n1, {words("name_2")} AS n2 FROM blended))""",
    """pair_features AS (SELECT p.pair_id, p.is_duplicate, f.* FROM name_pairs p JOIN features f ON f.name_1 = p.name_1 AND f.name_2 = p.name_2)""",
]

_WEIGHTED = {name: f"coalesce({name}, 0)::DOUBLE * 0.2::DOUBLE" for name in SCORED}
PAIR_SCORES = [
    *PAIR_FEATURES,
    f"""bounds AS (SELECT min(least({", ".join(_WEIGHTED.values())})) AS low, max(greatest({", ".join(_WEIGHTED.values())})) AS high FROM pair_features)""",
    f"""pair_scores AS (SELECT pair_id, is_duplicate, coalesce((({" + ".join(_WEIGHTED.values())}) / 5.0::DOUBLE - low) / nullif(high - low, 0), 0) AS score
       FROM pair_features, bounds)""",
    "predicted AS (SELECT *, CAST(score > 0.8 AS INTEGER) AS prediction FROM pair_scores)",
]


# --- Search -----------------------------------------------------------------------------------

# Edit distance with adjacent transpositions: fold over the token's characters, keeping the last two rows.
OSA = """list_reduce(list_transform(range(1, length(token) + 1), lambda i: [[i]]),
    lambda rows, e: [rows[2], list_reduce(list_transform(range(1, length(term) + 1), lambda j: [j]),
      lambda row, f: list_append(row, least(row[len(row)] + 1, rows[2][f[1] + 1] + 1,
        rows[2][f[1]] + CASE WHEN substr(token, e[1][1], 1) = substr(term, f[1], 1) THEN 0 ELSE 1 END,
        CASE WHEN e[1][1] > 1 AND f[1] > 1 AND substr(token, e[1][1], 1) = substr(term, f[1] - 1, 1)
               AND substr(token, e[1][1] - 1, 1) = substr(term, f[1], 1) THEN rows[1][f[1] - 1] + 1 ELSE 1000 END)),
      [e[1][1]])],
    [range(0, 0), range(0, length(term) + 1)])[2][length(term) + 1]"""

# Folding letters to ASCII never adds edits, so the built-in byte distance of the folded words leaves out no pair.
_ASCII = "regexp_replace(strip_accents({0}), '[^\\x00-\\x7f]', '?', 'g')"
NEAR_TWO_EDITS = f"""SELECT token, term, 1 - d / least(length(token), length(term))::DOUBLE AS weight FROM (
     SELECT token, term, {OSA} AS d FROM (SELECT token, {_ASCII.format("token")} AS t1 FROM tokens)
     JOIN (SELECT term, {_ASCII.format("term")} AS t2 FROM vocabulary)
       ON abs(length(token) - length(term)) <= 2 AND damerau_levenshtein(t1, t2) <= 2)
   WHERE d = 0 OR (d <= 2 AND d < least(length(token), length(term)))"""

FIELD_NO = {"company_name": 1, "company_url": 2, "normalized_name": 3, "query_string": 4}


def search(queries: str, fuzziness: int = 1, fields: tuple[str, ...] = tuple(FIELD_NO), docs: str = "company") -> list[str]:
    """``matches(query, position, match_key, score, ...)`` of all distinct queries, comparing everything with everything."""
    doc_fields = " UNION ALL ".join(
        f"SELECT doc_id, '{f}' AS field, {i} AS field_no, {f} AS text FROM {docs} WHERE {f} <> ''"
        for i, f in enumerate(fields, 1)
    )
    shortest = "list_sort([{'n': length(v), 'i': i, 'v': v} FOR v, i IN [company_name, company_url, normalized_name, query_string] IF v <> ''])[1].v"
    if fuzziness == 0:
        near = "SELECT token, term, 1.0::DOUBLE AS weight FROM tokens JOIN vocabulary ON term = token"
    elif fuzziness == 2:
        near = NEAR_TWO_EDITS
    else:
        near = """SELECT token, term, CASE WHEN token = term THEN 1.0 ELSE 1 - 1.0 / least(length(token), length(term)) END::DOUBLE AS weight
           FROM (SELECT token, term, list_filter(range(1, length(token) + 1), lambda i: substr(token, i, 1) <> substr(term, i, 1)) AS off
                 FROM tokens JOIN vocabulary ON abs(length(token) - length(term)) <= 1)
           WHERE token = term OR (least(length(token), length(term)) > 1 AND (
             (length(token) = length(term) AND len(off) = 1)
             OR (length(token) = length(term) AND len(off) = 2 AND off[2] = off[1] + 1
                 AND substr(token, off[1], 1) = substr(term, off[2], 1) AND substr(token, off[2], 1) = substr(term, off[1], 1))
             OR (length(token) = length(term) + 1 AND list_contains(list_transform(range(1, length(token) + 1), lambda i: substr(token, 1, i - 1) || substr(token, i + 1)), term))
             OR (length(term) = length(token) + 1 AND list_contains(list_transform(range(1, length(term) + 1), lambda i: substr(term, 1, i - 1) || substr(term, i + 1)), token))))"""
    return [
        f"doc_fields AS ({doc_fields})",
        f"doc_lists AS (SELECT doc_id, field, field_no, {index_terms('text')} AS terms FROM doc_fields)",
        "doc_terms AS (SELECT doc_id, field, field_no, len(terms) AS dl, unnest(terms) AS term FROM doc_lists WHERE len(terms) > 0)",
        "tfs AS (SELECT doc_id, field, field_no, dl, term, count(*) AS tf FROM doc_terms GROUP BY ALL)",
        "field_stats AS (SELECT field, count(*) AS n, avg(len(terms)) AS avgdl FROM doc_lists WHERE len(terms) > 0 GROUP BY field)",
        "dfs AS (SELECT field, term, count(*) AS df FROM tfs GROUP BY field, term)",
        "vocabulary AS (SELECT DISTINCT term FROM dfs)",
        f"query_terms AS (SELECT query, token, count(*) AS qtf FROM (SELECT query, unnest({index_terms('query')}) AS token FROM (SELECT DISTINCT query FROM {queries})) GROUP BY ALL)",
        "tokens AS (SELECT DISTINCT token FROM query_terms)",
        f"near AS ({near})",
        """engine AS (SELECT query, field, field_no, doc_id, round(sum(qtf * weight * ln(1 + (n - df + 0.5) / (df + 0.5)) * 2.2::DOUBLE * tf / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avgdl))), 9) AS engine_score
           FROM query_terms JOIN near USING (token) JOIN tfs USING (term) JOIN dfs USING (field, term) JOIN field_stats USING (field)
           GROUP BY query, field, field_no, doc_id)""",
        """hits AS (SELECT *, row_number() OVER (PARTITION BY query, field ORDER BY engine_score DESC, doc_id) AS hit_rank FROM engine
           QUALIFY hit_rank <= 10)""",
        f"named AS (SELECT h.*, d.* EXCLUDE (doc_id), {shortest} AS match_key FROM hits h JOIN {docs} d ON d.doc_id = h.doc_id WHERE engine_score > 0.01)",
        "search_names AS (SELECT query AS name_1, match_key AS name_2 FROM named)",
        *token_set_scores("search_names"),
        """relevant AS (SELECT n.*, token_set_ratio / 100.0::DOUBLE AS score FROM named n JOIN token_set t ON t.name_1 = query AND t.name_2 = match_key
           WHERE token_set_ratio / 100.0::DOUBLE > 0.3)""",
        """per_field AS (SELECT query, field_no, match_key, score, min(hit_rank) AS first_rank,
             arg_max({'n': company_name, 'u': company_url, 'm': normalized_name}, hit_rank) AS payload
           FROM relevant GROUP BY query, field_no, match_key, score)""",
        """merged AS (SELECT query, match_key, max(score) AS score, min(field_no) AS field_no, arg_min(first_rank, field_no) AS first_rank,
             arg_min(payload, field_no) AS payload FROM per_field GROUP BY query, match_key)""",
        """matches AS (SELECT query, row_number() OVER (PARTITION BY query ORDER BY score DESC, field_no, first_rank) AS position,
             match_key, score, payload.n AS company_name, payload.u AS company_url, payload.m AS normalized_name FROM merged)""",
    ]


MATCH_COLUMNS = "position, match_key, round(score, 6) AS score, company_name, company_url, normalized_name"


def search_query(fuzziness: int) -> str:
    return with_(
        [TITLES, COMPANY, QUERY_NAMES, *search("query_names", fuzziness)],
        f"SELECT query_id, query, {MATCH_COLUMNS} FROM query_names JOIN matches USING (query)",
    )


# --- Trials ------------------------------------------------------------------------------------


def trials(n: int) -> str:
    """The registered trials: an arithmetic sequence through the search space."""
    cells = ", ".join(f"((i * {2 * j + 3}) % 11) / 10.0::DOUBLE AS w_{name}" for j, name in enumerate(SCORED))
    return f"trials AS (SELECT CAST(i AS INTEGER) AS trial_id, 0.2::DOUBLE + ((i * 7) % {n}) * 0.8::DOUBLE / {n} AS threshold, {cells} FROM range({n}) r(i))"


def folds(k: int = 5) -> list[str]:
    """Sort rows by class, deal them out: how many of each class each fold gets. Then cut each class in order."""
    return [
        "class_first AS (SELECT is_duplicate, min(pair_id) AS f FROM name_pairs GROUP BY 1)",
        f"dealt AS (SELECT is_duplicate, (row_number() OVER (ORDER BY f, pair_id) - 1) % {k} AS fold FROM name_pairs JOIN class_first USING (is_duplicate))",
        "allocation AS (SELECT is_duplicate, fold, count(*) AS n FROM dealt GROUP BY ALL)",
        "ends AS (SELECT is_duplicate, fold, sum(n) OVER (PARTITION BY is_duplicate ORDER BY fold) AS upto FROM allocation)",
        "ranked AS (SELECT *, row_number() OVER (PARTITION BY is_duplicate ORDER BY pair_id) AS rn FROM name_pairs)",
        """folded AS (SELECT r.pair_id, r.is_duplicate, min(e.fold) AS fold FROM ranked r JOIN ends e ON e.is_duplicate = r.is_duplicate AND r.rn <= e.upto
           GROUP BY ALL)""",
    ]


def _trial_weighted(prefix: str = "t.") -> list[str]:
    return [f"{prefix}w_{name} * coalesce(f.{name}, 0)::DOUBLE" for name in SCORED]


def drawn_trials(n: int) -> str:
    """Trials as the search draws them."""
    rows = ", ".join("(" + ", ".join(f"'{value!r}'" for value in trial.values()) + ")" for trial in random_trials(n))
    names = ("threshold", *(f"w_{name}" for name in SCORED))
    cells = ", ".join(f"{name}::DOUBLE AS {name}" for name in names)
    return f"trials AS (SELECT trial_id::INTEGER AS trial_id, {cells} FROM (VALUES {rows}) v(trial_id, {', '.join(names)}))"


def trial_results(tried: str) -> list[str]:
    terms = _trial_weighted()
    return [
        *PAIR_FEATURES,
        *folds(),
        tried,
        f"""trial_rows AS (SELECT t.trial_id, t.threshold, d.fold, d.is_duplicate, ({" + ".join(terms)}) / 5.0::DOUBLE AS mean,
             least({", ".join(terms)}) AS low, greatest({", ".join(terms)}) AS high
           FROM folded d JOIN pair_features f ON f.pair_id = d.pair_id, trials t)""",
        "trial_bounds AS (SELECT trial_id, fold, min(low) AS low, max(high) AS high FROM trial_rows GROUP BY ALL)",
        """trial_folds AS (SELECT r.trial_id, r.fold, avg(CAST((coalesce((mean - b.low) / nullif(b.high - b.low, 0), 0) > threshold) = (is_duplicate = 1) AS INTEGER)) AS accuracy
           FROM trial_rows r JOIN trial_bounds b ON b.trial_id = r.trial_id AND b.fold = r.fold GROUP BY ALL)""",
        "results AS (SELECT t.*, round(o.objective, 9) AS objective FROM trials t JOIN (SELECT trial_id, 1 - avg(accuracy) AS objective FROM trial_folds GROUP BY 1) o USING (trial_id))",
    ]


# --- Registered SQL --------------------------------------------------------------------------------


def _oracles() -> dict[str, str]:
    sql: dict[str, str] = {}
    names = [TITLES, LEGAL_NAMES]
    clean = f"SELECT id, name, {normalized('name')} AS normalized FROM legal_names"
    sql["normalize_names"] = with_(names, f"SELECT *, {capitalized('normalized')} AS capitalized FROM ({clean})")
    sql["normalize_pipeline"] = with_(names, clean)
    legal = "name"
    for word in text.LEGAL_FORM_WORDS:
        legal = f"replace({legal}, CASE WHEN contains(name, {q(word)}) THEN {q(word)} ELSE chr(1) END, '')"
    singles = "".join(text.SINGLE_LETTERS)
    latin = f"translate(name, {q(singles)}, {q(''.join(text.SINGLE_LETTERS.values()))})"
    for letter, spelling in text.MULTI_LETTERS.items():
        latin = f"replace({latin}, {q(letter)}, {q(spelling)})"
    without_suffixes = strip(f"regexp_replace(name, {q(text.SUFFIX_PATTERN)}, '', 'g')")
    sql["normalize_steps"] = with_(
        names,
        f"""SELECT id, lower(name) AS lowercased, {strip(legal)} AS without_legal_forms,
          {without_suffixes} AS without_suffixes, {eliminated("name", chr(92) + "p{Nd}+")} AS without_numbers,
          {eliminated("name", f"[^{W}]+")} AS without_non_words, {latin} AS transliterated FROM legal_names""",
    )
    sql["name_tokens"] = with_(
        names,
        f"""SELECT id, array_to_string({words("name")}, '|') AS words, array_to_string({index_terms("name")}, '|') AS index_terms,
          replace(name, ' ', '+') AS escaped FROM legal_names""",
    )
    sql["decoded_queries"] = with_([TITLES], f"SELECT page_id AS query_id, {normalized('title')} AS query FROM titles")
    ws = "string_split(title, ' ')"
    sql["entity_names"] = with_(
        [
            TITLES,
            f"known AS (SELECT DISTINCT {ws}[list_position(list_transform({ws}, lambda w: length(w)), list_max(list_transform({ws}, lambda w: length(w))))] AS name FROM titles)",
            f"title_words AS (SELECT page_id, title, {words('title')} AS ws FROM titles)",
            "starts AS (SELECT page_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM title_words)",
            "runs AS (SELECT page_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS name FROM starts, (VALUES (1), (2)) s(n) WHERE i + n - 1 <= len(ws))",
            "found AS (SELECT page_id, arg_min(name, i * 10 - n) AS name FROM runs JOIN known USING (name) GROUP BY page_id)",
        ],
        "SELECT page_id, coalesce(name, title) AS title FROM titles LEFT JOIN found USING (page_id)",
    )
    sql["page_records"] = with_(
        [TITLES, COMPANY],
        """SELECT company_url AS url, company_name, company_url, query_string, normalized_name, 'ok' AS status, 0 AS error_code,
          '' AS error_message FROM company""",
    )
    href = q(r"""(?is)<a\s[^>]*?href\s*=\s*["']([^"']*)["']""")
    excluded = q("^(?:" + "|".join(markup.EXCLUDED_LINKS) + ")")
    links = f"""SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS position, link FROM (
          SELECT page_id, {unescaped("links[i]")} AS link, i FROM (SELECT page_id, links, unnest(range(1, len(links) + 1)) AS i FROM (
            SELECT page_id, regexp_extract_all(html, {href}, 1) AS links FROM pages))) WHERE NOT regexp_matches(link, {excluded})"""
    sql["page_links"] = links
    sql["first_page_links"] = f"SELECT * FROM ({links}) WHERE position < 2"

    sql["result_links"] = "SELECT page_id, 0 AS position, url AS link FROM pages"
    sql["result_links_of_stored_pages"] = sql["result_links"]
    sql["record_lookup"] = with_(
        [TITLES, COMPANY, CANDIDATE_PAGES, "asked AS (SELECT DISTINCT url FROM candidate_pages UNION ALL SELECT 'https://none/' || s_name FROM supplier)"],
        """SELECT url, coalesce(company_name, '') AS company_name, coalesce(company_url, '') AS company_url, '' AS query_string,
          coalesce(normalized_name, '') AS normalized_name FROM asked LEFT JOIN company ON company_url = url""",
    )

    negative = "negatives AS (SELECT *, (row_number() OVER (ORDER BY pair_id) - 1) // 1000 AS chunk_id FROM name_pairs WHERE is_duplicate = 0)"
    stacked = "stacked AS (SELECT chunk_id, name_1 AS name FROM negatives UNION ALL SELECT chunk_id, name_2 FROM negatives)"
    for key, chunk in (("bulk_load_frame", ""), ("bulk_load_chunks", "chunk_id, ")):
        sql[key] = with_(
            [TITLES, NAME_PAIRS, negative, stacked, f"kept AS (SELECT DISTINCT {chunk}name FROM stacked WHERE length(name) >= 2)",
             f"clean AS (SELECT {chunk}name, {normalized('name')} AS normalized_name FROM kept)"],
            f"SELECT {chunk}{capitalized('normalized_name')} AS company_name, normalized_name, '' AS company_url, name AS query_string FROM clean",
        )
    sql["symmetric_pairs"] = with_(
        [TITLES, NAME_PAIRS],
        "SELECT name_1, name_2, is_duplicate FROM name_pairs UNION SELECT name_2, name_1, is_duplicate FROM name_pairs",
    )
    sql["distinct_names"] = with_([TITLES, NAME_PAIRS], "SELECT name_1 AS name FROM name_pairs UNION SELECT name_2 FROM name_pairs")
    sql["swapped_pairs"] = with_([TITLES, NAME_PAIRS], "SELECT pair_id, name_2 AS name_1, name_1 AS name_2, is_duplicate FROM name_pairs")
    sql["pair_slice"] = with_([TITLES, NAME_PAIRS], "SELECT * FROM name_pairs WHERE is_duplicate = 0 ORDER BY pair_id OFFSET 100")
    sql["pairs_csv"] = with_([TITLES, NAME_PAIRS], "SELECT * FROM name_pairs")
    sql["pair_features"] = with_(
        PAIR_FEATURES,
        """SELECT pair_id, is_duplicate, levenshtein, ratio, partial_ratio, token_sort_ratio, token_set_ratio, wratio,
          round(subs_ratio, 6) AS subs_ratio FROM pair_features""",
    )
    sql["pair_scores"] = with_(
        PAIR_SCORES,
        f"""SELECT pair_id, is_duplicate, round(score, 6) AS score, prediction,
          CASE WHEN round(score, 6) > 0.99 THEN {q("Одинаковое название")} ELSE {q("Другое название")} END AS verdict FROM predicted""",
    )
    sql["positions"] = "SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS position FROM orders"
    sql["positions_of_hashes"] = """SELECT o_orderkey, o_orderstatus, md5(o_orderkey::VARCHAR) AS hashed,
      row_number() OVER (PARTITION BY o_orderstatus ORDER BY hashed) AS position FROM orders"""
    sql["positions_of_texts"] = """SELECT lang, doc_id,
      row_number() OVER (PARTITION BY lang ORDER BY text NULLS FIRST, doc_id NULLS FIRST) AS position FROM documents"""
    sql["balanced_split"] = with_(
        [TITLES, NAME_PAIRS, "sizes AS (SELECT count(*) AS pos FROM name_pairs WHERE is_duplicate = 1)",
         "ranked AS (SELECT *, row_number() OVER (PARTITION BY is_duplicate ORDER BY pair_id) AS rn FROM name_pairs)"],
        """SELECT pair_id, is_duplicate, CASE WHEN rn <= round_even(pos * 0.2, 0) THEN 'test'
          WHEN is_duplicate = 1 OR rn <= pos THEN 'train_balanced' ELSE 'train' END AS split FROM ranked, sizes""",
    )
    sql["kfold"] = with_([TITLES, NAME_PAIRS, *folds()], "SELECT pair_id, is_duplicate, CAST(fold AS INTEGER) AS fold FROM folded")

    sql["random_split"] = with_(
        [TITLES, NAME_PAIRS],
        "SELECT pair_id, CASE WHEN CAST('0x' || substr(md5('69:' || pair_id), 1, 8) AS BIGINT) % 100 < 33 THEN 'test' ELSE 'train' END AS split FROM name_pairs",
    )
    sql["confusion"] = with_(PAIR_SCORES, "SELECT is_duplicate AS label, prediction, count(*) AS n FROM predicted GROUP BY ALL")
    counts = """counts AS (SELECT count(*) FILTER (is_duplicate = 1 AND prediction = 1) AS tp, count(*) FILTER (is_duplicate = 0 AND prediction = 1) AS fp,
      count(*) FILTER (is_duplicate = 1 AND prediction = 0) AS fn, count(*) FILTER (is_duplicate = 0 AND prediction = 0) AS tn FROM predicted)"""
    per_class = """per_class AS (
      SELECT '0' AS entry, coalesce(tn / nullif(tn + fn, 0), 0) AS p, coalesce(tn / nullif(tn + fp, 0), 0) AS r, coalesce(2 * tn / nullif(2 * tn + fn + fp, 0), 0) AS f, tn + fp AS s FROM counts
      UNION ALL SELECT '1', coalesce(tp / nullif(tp + fp, 0), 0), coalesce(tp / nullif(tp + fn, 0), 0), coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), tp + fn FROM counts)"""
    sql["classification_report"] = with_(
        [*PAIR_SCORES, counts, per_class],
        """SELECT entry, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, CAST(s AS DOUBLE) AS support FROM per_class
          UNION ALL SELECT 'accuracy', round(a, 6), round(a, 6), round(a, 6), CAST(n AS DOUBLE) FROM (SELECT (tp + tn) / (tp + fp + fn + tn) AS a, tp + fp + fn + tn AS n FROM counts)
          UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(s) AS DOUBLE) FROM per_class
          UNION ALL SELECT 'weighted avg', round(sum(p * s) / sum(s), 6), round(sum(r * s) / sum(s), 6), round(sum(f * s) / sum(s), 6), CAST(sum(s) AS DOUBLE) FROM per_class""",
    )
    sql["score_summary"] = with_(
        [*PAIR_SCORES, counts],
        """SELECT round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1,
          round((coalesce(tp / nullif(tp + fn, 0), 0) + coalesce(tn / nullif(tn + fp, 0), 0)) / 2, 6) AS roc_auc_labels FROM counts""",
    )
    sweep = """sweep AS (SELECT i / 100.0::DOUBLE AS threshold, count(*) FILTER (score > i / 100.0::DOUBLE AND is_duplicate = 1) AS tp,
        count(*) FILTER (score > i / 100.0::DOUBLE AND is_duplicate = 0) AS fp, count(*) FILTER (score <= i / 100.0::DOUBLE AND is_duplicate = 1) AS fn
      FROM predicted, range(100) r(i) GROUP BY i)"""
    scored_sweep = "swept AS (SELECT *, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM sweep)"
    sql["threshold_sweep"] = with_([*PAIR_SCORES, sweep, scored_sweep], "SELECT threshold, tp, fp, fn, round(f1, 6) AS f1 FROM swept")
    sql["best_threshold"] = with_(
        [*PAIR_SCORES, sweep, scored_sweep],
        """SELECT * FROM (SELECT threshold, round(f1, 6) AS f1, 'best' AS mode FROM swept ORDER BY swept.f1 DESC, threshold LIMIT 1)
          UNION ALL SELECT * FROM (SELECT threshold, round(f1, 6), 'last_positive' FROM swept WHERE swept.f1 > 0 ORDER BY threshold DESC LIMIT 1)""",
    )
    sql["roc_auc"] = with_(
        [*PAIR_SCORES, """ranked_scores AS (SELECT is_duplicate, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS r FROM predicted)""",
         "rank_sums AS (SELECT sum(r) FILTER (is_duplicate = 1) AS s, count(*) FILTER (is_duplicate = 1) AS p, count(*) FILTER (is_duplicate = 0) AS n FROM ranked_scores)"],
        "SELECT round((s - p * (p + 1) / 2) / (p * n), 6) AS roc_auc, p AS positives, n AS negatives FROM rank_sums",
    )
    close = """CASE WHEN pair_id % 6 = 0 THEN 0 WHEN pair_id % 6 = 1 THEN 1 ELSE score / 16777216 END"""
    sql["score_area_of_close_scores"] = with_(
        [*PAIR_SCORES, f"close_scores AS (SELECT is_duplicate, {close} AS close FROM predicted)",
         """ranked_scores AS (SELECT is_duplicate, rank() OVER (ORDER BY close) + (count(*) OVER (PARTITION BY close) - 1) / 2.0::DOUBLE AS r FROM close_scores)""",
         "rank_sums AS (SELECT sum(r) FILTER (is_duplicate = 1) AS s, count(*) FILTER (is_duplicate = 1) AS p, count(*) FILTER (is_duplicate = 0) AS n FROM ranked_scores)"],
        "SELECT round((s - p * (p + 1) / 2) / (p * n), 6) AS roc_auc, p AS positives, n AS negatives FROM rank_sums",
    )

    weights = ", ".join(f"w_{name}" for name in SCORED)
    results = trial_results(trials(20))
    sql["tune_weights"] = with_(results, f"SELECT trial_id, round(threshold, 6) AS threshold, {weights}, round(objective, 6) AS objective FROM results ORDER BY results.objective, trial_id LIMIT 1")
    drawn = ", ".join(f"round(w_{name}, 6) AS w_{name}" for name in SCORED)
    sql["weight_search"] = with_(
        trial_results(drawn_trials(100)),
        f"SELECT trial_id, round(threshold, 6) AS threshold, {drawn}, round(objective, 6) AS objective FROM results",
    )
    sql["trial_history"] = with_(results, "SELECT trial_id, round(objective, 6) AS objective, round(min(results.objective) OVER (ORDER BY trial_id), 6) AS best_so_far FROM results")
    sql["trial_distribution"] = with_(results, "SELECT trial_id, round(objective, 6) AS objective, round(cume_dist() OVER (ORDER BY results.objective), 6) AS share FROM results")
    sql["trial_histogram"] = with_(results, "SELECT CAST(least(floor(objective * 10), 9) AS INTEGER) AS bin, count(*) AS n FROM results GROUP BY 1")
    sql["trial_evaluations"] = with_(
        results,
        " UNION ALL ".join(
            f"SELECT trial_id, round(objective, 6) AS objective, '{p}' AS parameter, round({p}, 6) AS value FROM results"
            for p in ("threshold", *(f"w_{name}" for name in SCORED))
        ),
    )

    closure = [
        TITLES,
        NAME_PAIRS,
        "links AS (SELECT name_1 AS a, name_2 AS b FROM name_pairs WHERE is_duplicate = 1 UNION SELECT name_2, name_1 FROM name_pairs WHERE is_duplicate = 1)",
        "names AS (SELECT name_1 AS name FROM name_pairs UNION SELECT name_2 FROM name_pairs)",
        "reach(name, other) AS (SELECT name, name FROM names UNION SELECT reach.name, links.b FROM reach JOIN links ON links.a = reach.other)",
        "clusters AS (SELECT name, min(other) AS cluster_id FROM reach GROUP BY name)",
        "sizes AS (SELECT cluster_id, count(*) AS size FROM clusters GROUP BY cluster_id)",
    ]
    sql["name_clusters"] = with_(closure, "SELECT name, cluster_id FROM clusters", recursive=True)
    sql["cluster_sizes"] = with_(closure, "SELECT cluster_id, size FROM sizes", recursive=True)
    sql["large_clusters"] = with_(closure, "SELECT cluster_id, size FROM sizes WHERE size > 4 ORDER BY cluster_id LIMIT 3", recursive=True)
    sql["cluster_uniqueness"] = with_(closure, "SELECT count(*) AS members, count(DISTINCT name) AS distinct_members FROM clusters", recursive=True)
    sql["frontier_neighbours"] = with_(
        [TITLES, NAME_PAIRS],
        """SELECT name_1, name_2, is_duplicate FROM (SELECT name_1, name_2, is_duplicate FROM name_pairs WHERE is_duplicate = 1
            UNION SELECT name_2, name_1, is_duplicate FROM name_pairs WHERE is_duplicate = 1)
          WHERE name_1 IN (SELECT p_name FROM part)""",
    )

    chars = [
        TITLES,
        NAME_PAIRS,
        "lowered AS (SELECT lower(name_1) AS n FROM name_pairs UNION SELECT lower(name_2) FROM name_pairs)",
        "chars AS (SELECT DISTINCT unnest(list_transform(range(1, length(n) + 1), lambda i: substr(n, i, 1))) AS ch FROM lowered)",
        "vocab AS (SELECT ch, CAST(row_number() OVER (ORDER BY unicode(ch)) - 1 AS INTEGER) AS id FROM chars)",
    ]
    sql["char_vocab"] = with_(chars, "SELECT ch, id FROM vocab")
    sql["name_length"] = with_([TITLES, NAME_PAIRS], "SELECT max(greatest(length(name_1), length(name_2))) AS max_length FROM name_pairs")
    codes = "list_transform(range(1, 256), lambda i: CASE WHEN i <= length({0}) THEN ids[substr(lower({0}), i, 1)] ELSE pad END)"
    sql["char_encode"] = with_(
        [*chars, "mapping AS (SELECT map(list(ch), list(id)) AS ids, max(id) + 1 AS pad FROM vocab)"],
        f"""SELECT pair_id, array_to_string({codes.format("name_1")}, ',') || ',' || array_to_string({codes.format("name_2")}, ',') AS codes,
          lower(name_1) AS decoded FROM name_pairs, mapping""",
    )

    sql["term_stats"] = with_(
        [TITLES, COMPANY, QUERY_NAMES, *search("query_names", 0)],
        "SELECT field, term, df, round(ln(1 + (n - df + 0.5) / (df + 0.5)), 6) AS idf FROM dfs JOIN field_stats USING (field)",
    )
    sql["fuzzy_terms"] = with_(
        [TITLES, COMPANY, QUERY_NAMES, *search("query_names", 1)], "SELECT token, term, round(weight, 6) AS weight FROM near"
    )
    sql["bulk_loaded_store"] = sql["bulk_load_frame"]
    sql["restored_store"] = with_([TITLES, COMPANY], "SELECT company_name, company_url, query_string, normalized_name FROM company")
    sql["validated_payloads"] = with_(
        [TITLES, COMPANY], "SELECT company_name, true AS valid FROM company UNION ALL SELECT s_name, false FROM supplier"
    )
    sql["fuzzy_terms_two_edits"] = with_(
        [TITLES, COMPANY, QUERY_NAMES, *search("query_names", 2)], "SELECT token, term, round(weight, 6) AS weight FROM near"
    )
    joined = "SELECT DISTINCT replace({0}, ' ', '') AS {1} FROM {2}"
    sql["fuzzy_long_terms"] = with_(
        [TITLES, QUERY_NAMES, f"tokens AS ({joined.format('query', 'token', 'query_names')})",
         f"vocabulary AS ({joined.format('lower(title)', 'term', 'titles')})", f"near AS ({NEAR_TWO_EDITS})"],
        "SELECT token, term, round(weight, 6) AS weight FROM near",
    )
    sql["fuzzy_search_two_edits"] = search_query(2)
    sql["fuzzy_search"] = search_query(1)
    sql["fuzzy_search_exact"] = search_query(0)
    base = [TITLES, COMPANY, QUERY_NAMES]
    sql["nearest_name"] = with_(
        [*base, MIXED_QUERIES, *search("mixed_queries")],
        """SELECT query_id, query, match_key, round(score, 6) AS score, company_name, company_url, normalized_name,
          match_key IS NOT NULL AS exists FROM mixed_queries LEFT JOIN (SELECT * FROM matches WHERE position = 1) USING (query)""",
    )
    typed = """list_transform(string_split(lower(title), ' '), lambda w: CASE WHEN length(w) >= 4
      THEN substr(w, 1, 1) || substr(w, 3) || substr(w, length(w), 1) ELSE w END)"""
    gram_names = """SELECT name, list_distinct([substr(' ' || name || ' ', i, 2) FOR i IN range(1, length(name) + 2)]) AS grams
      FROM (SELECT DISTINCT {0} AS name FROM {1}) WHERE name <> ''"""
    squeezed = r"lower(trim(regexp_replace({0}, '[ \t\n\x0B\f\r]+', ' ', 'g')))"
    sql["nearest_name_by_grams"] = with_(
        [TITLES, f"""asked AS (SELECT 2 * page_id AS query_id, array_to_string({typed}, ' ') AS query FROM titles
           UNION ALL SELECT 2 * s_suppkey + 1, lower(s_name) FROM supplier)""",
         f"lefts AS ({gram_names.format(squeezed.format('query'), 'asked')})",
         f"rights AS ({gram_names.format(squeezed.format(capitalized('title')), 'titles')})",
         """near AS (SELECT l.name AS name_1, r.name AS name_2, len(list_intersect(l.grams, r.grams)) AS shared,
              len(l.grams) + len(r.grams) - shared AS in_either FROM lefts l, rights r WHERE 2 * shared >= in_either)""",
         *token_set_scores("near"),
         """best AS (SELECT * FROM near JOIN token_set USING (name_1, name_2)
            QUALIFY row_number() OVER (PARTITION BY name_1 ORDER BY token_set_ratio DESC, shared / in_either DESC, name_2) = 1)""",
         f"ids AS (SELECT {squeezed.format(capitalized('title'))} AS name_2, min(page_id) AS doc_id FROM titles GROUP BY 1)"],
        f"""SELECT query_id, query, doc_id, name_2 AS name, round(token_set_ratio / 100.0::DOUBLE, 6) AS score, shared, in_either,
          doc_id IS NOT NULL AS exists FROM asked LEFT JOIN (SELECT * FROM best JOIN ids USING (name_2)) ON name_1 = {squeezed.format('query')}""",
    )
    sql["search_response"] = with_(
        [*base, *search("query_names")],
        """SELECT query_id, query, match_key, round(score, 6) AS score, company_name, company_url, normalized_name,
          printf('%.2f', score) AS score_text FROM query_names JOIN matches USING (query)""",
    )
    arriving = f"{capitalized('query')} AS company_name, '' AS company_url, query AS query_string, query AS normalized_name"
    sql["insert_if_absent"] = with_(
        [*base, MIXED_QUERIES, *search("mixed_queries", 0, ("normalized_name",))],
        f"SELECT {arriving} FROM mixed_queries WHERE query NOT IN (SELECT query FROM matches)",
    )
    sql["insert_if_absent_exact"] = with_(
        [*base, MIXED_QUERIES],
        f"SELECT {arriving} FROM mixed_queries WHERE query NOT IN (SELECT normalized_name FROM company)",
    )
    enriched = [
        *base,
        MIXED_QUERIES,
        CANDIDATE_PAGES,
        *search("mixed_queries"),
        "missed AS (SELECT * FROM mixed_queries WHERE query NOT IN (SELECT query FROM matches))",
        "chosen AS (SELECT m.query_id, m.query, arg_min(c.url, c.rank) AS url FROM missed m JOIN candidate_pages c USING (query_id) GROUP BY ALL)",
        "found AS (SELECT h.query_id, h.query, d.company_name, d.company_url, d.normalized_name FROM chosen h JOIN company d ON d.company_url = h.url)",
    ]
    second = [
        cte.replace("lcs", "found_lcs").replace("ts_", "found_ts_").replace("token_set AS", "found_set AS")
        .replace("token_parts", "found_parts").replace("token_sets", "found_sets")
        .replace("tokenized", "found_tokenized").replace("processed AS", "found_processed AS").replace("FROM processed", "FROM found_processed")
        for cte in token_set_scores("found_names")
    ]
    sql["search_then_enrich"] = with_(
        [*enriched, "found_names AS (SELECT query AS name_1, normalized_name AS name_2 FROM found)", *second],
        """SELECT query_id, query, match_key, round(score, 6) AS score, company_name, company_url, normalized_name, '' AS query_string, 'index' AS source
            FROM mixed_queries JOIN matches USING (query)
          UNION ALL SELECT query_id, query, normalized_name, round(token_set_ratio / 100.0::DOUBLE, 6), company_name, company_url, '', query, 'page'
            FROM found JOIN found_set ON name_1 = query AND name_2 = normalized_name""",
    )
    sql["enrichment_records"] = with_(enriched, "SELECT company_name, company_url, query AS query_string, normalized_name FROM found")
    sql["stream_insert"] = with_(
        base,
        f"""SELECT company_name, arg_min(company_url, company_name || chr(0) || company_url) AS company_url, '' AS query_string, normalized_name
            FROM company WHERE company_name <> '' AND normalized_name NOT IN (SELECT lower(s_name) FROM supplier) GROUP BY company_name, normalized_name
          UNION ALL SELECT {capitalized("lower(s_name)")}, '', lower(s_name), lower(s_name) FROM supplier""",
    )
    heading = "regexp_extract(html, '<h1>(.*?)</h1>', 1)"
    sql["stream_values"] = with_(
        [TITLES], f"SELECT url, title AS value FROM titles WHERE title <> '' UNION ALL SELECT url, {heading} FROM pages WHERE {heading} <> ''"
    )
    partial = "SELECT {0} || s_name || {1} AS what FROM supplier UNION ALL SELECT {2} || p_name FROM part"
    name, broken = q('{"company_name": "'), q('{"company_name": "')
    in_dump = partial.format(q('{"_source": {"company_name": "'), q('"}}'), broken)
    in_payloads = partial.format(name, q('"}'), broken)
    for key, rejected in (("restored_dump_with_rejects", in_dump), ("quarantined_rows", in_payloads)):
        sql[key] = with_([TITLES, COMPANY], f"SELECT 'stored' AS outcome, company_name AS what FROM company UNION ALL SELECT 'rejected', what FROM ({rejected})")
    sql["insert_batch_once"] = with_(
        [TITLES, COMPANY],
        """SELECT 'stored' AS outcome, company_name AS what FROM (SELECT min(company_name) AS company_name FROM company GROUP BY normalized_name)
           UNION ALL SELECT 'rejected', company_name FROM company""",
    )
    sql["segmented_search"] = with_(
        [*base,
         """numbered AS (SELECT row_number() OVER (ORDER BY doc_id % 4, company_name, company_url, normalized_name, query_string) AS doc_id,
              * EXCLUDE (doc_id) FROM company)""",
         *search("query_names", docs="numbered")],
        f"SELECT query_id, query, {MATCH_COLUMNS} FROM query_names JOIN matches USING (query)",
    )
    sql["fuzzy_search_hot"] = search_query(1)
    sql["fuzzy_search_hot_exact"] = search_query(0)
    sql["stored_enrichment"] = with_(
        enriched,
        # The query names its record where it is shorter than the company's name.
        "SELECT query_id, query, company_name, company_url, 1.0::DOUBLE AS score FROM found WHERE length(query) < length(company_name)",
    )
    fresh = "company_name <> '' AND normalized_name NOT IN (SELECT query FROM matches)"
    sql["stream_insert_relevant"] = with_(
        [*base, "odd AS (SELECT * FROM query_names WHERE query_id % 2 = 0)",
         "stored AS (SELECT query_id AS doc_id, '' AS company_name, '' AS company_url, query AS normalized_name, '' AS query_string FROM odd)",
         "arriving AS (SELECT DISTINCT normalized_name AS query FROM company)",
         *search("arriving", 0, ("normalized_name",), "stored")],
        f"""SELECT company_name, arg_min(company_url, company_name || chr(0) || company_url) AS company_url, '' AS query_string, normalized_name
            FROM company WHERE {fresh} GROUP BY company_name, normalized_name
          UNION ALL SELECT {capitalized("query")}, '', query, query FROM odd""",
    )
    return sql


ORACLES = _oracles()
