"""The fixtures and the cleaning rules once more, as common table expressions of plain SQL,
to hold the engine's results against."""

from __future__ import annotations

from ..functions.text import ABSTRACT_HEADS, NOUN_STOP, SHOT_PHRASES, STOP
from .profiles import PROFILES, Profile


def quoted(words: list[str]) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def norm(s: str) -> str:
    return f"trim(regexp_replace(regexp_replace(lower({s}), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g'))"


def content(n: str) -> str:
    return f"list_filter(string_split({n}, ' '), lambda w: w <> '' AND w NOT IN ({quoted(STOP)}))"


def nouns(s: str) -> str:
    return f"list_distinct(list_filter(regexp_extract_all(lower(coalesce({s}, '')), '[a-z][a-z\\-'']+'), lambda w: length(w) > 2 AND w NOT IN ({quoted(NOUN_STOP)})))"


def words(s: str) -> str:
    return f"CAST(len(list_filter(regexp_split_to_array({s}, '\\s+'), lambda w: w <> '')) AS BIGINT)"


VAGUE = "'^(the|this|a|an)?\\s*(entire|whole|overall)?\\s*(image|photo|photograph|picture|scene|view|frame|composition|background|foreground)s?$'"


def vague(p: str) -> str:
    return f"regexp_matches({p}, {VAGUE}, 'i')"


def iou(a: str, b: str) -> str:
    inter = f"((least({a}[3], {b}[3]) - greatest({a}[1], {b}[1])) * (least({a}[4], {b}[4]) - greatest({a}[2], {b}[2])))"
    union = f"(({a}[3] - {a}[1]) * ({a}[4] - {a}[2]) + ({b}[3] - {b}[1]) * ({b}[4] - {b}[2]) - {inter})"
    return f"(CASE WHEN least({a}[3], {b}[3]) <= greatest({a}[1], {b}[1]) OR least({a}[4], {b}[4]) <= greatest({a}[2], {b}[2]) OR {union} <= 0 THEN 0.0::DOUBLE ELSE {inter} / {union} END)"


def rounded(x: str, digits: int) -> str:
    """By the binary value, ties to even, from the exact error of the product."""
    ten = f"1e{digits}::DOUBLE"
    high = "(v * 134217729.0::DOUBLE - (v * 134217729.0::DOUBLE - v))"
    p = f"(v * {ten})"
    over = f"({p} - floor({p}) - 0.5::DOUBLE + (({high} * {ten} - {p}) + (v - {high}) * {ten}))"
    return f"list_transform([CAST({x} AS DOUBLE)], lambda v: (floor({p}) + CASE WHEN {over} > 0 THEN 1 WHEN {over} < 0 THEN 0 ELSE CAST(floor({p}) AS BIGINT) % 2 END) / {ten})[1]"


def escaped(s: str) -> str:
    for mark, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("''", "&#x27;")):
        s = f"replace({s}, '{mark}', '{name}')"
    return s


def dedup(boxes: str) -> str:
    return f"list_reduce(list_transform({boxes}, lambda b: [b]), lambda acc, e: CASE WHEN len(list_filter(acc, lambda q: {iou('e[1]', 'q')} > 0.9)) = 0 THEN list_concat(acc, e) ELSE acc END)"


_A, _B = ("coalesce(w[3 * ({i}) + 1], '')", "coalesce(w[3 * ({i}) + 2], '')")


def _base(i: str) -> str:
    return "(" + _A.format(i=i) + " || ' ' || " + _B.format(i=i) + ")"


#: docs, fx (doc_id, k, phrase, boxes): k is the place of the phrase in its grounding.
FIXTURE = f"""
docs AS (SELECT *, {norm('text')} AS cap FROM documents),
fx_e AS (SELECT doc_id, string_split(cap, ' ') AS w, unnest(range(0, 4 + doc_id % 12)) AS k FROM docs),
fx_p AS (SELECT doc_id, k, CASE WHEN (doc_id + k) % 7 = 0 AND k > 0 THEN k - 1 ELSE k END AS kk,
  CASE WHEN (doc_id + k) % 13 = 0 THEN 'the entire image' WHEN (doc_id + k) % 11 = 0 THEN substr({_base('k')}, 2) || 'q'
       WHEN (doc_id + k) % 17 = 0 THEN {_base('k')} || ' lighting' WHEN (doc_id + k) % 7 = 0 AND k > 0 THEN upper({_base('k - 1')}) ELSE {_base('k')} END AS phrase FROM fx_e),
fx_n AS (SELECT doc_id, phrase, min(k) AS k, min(kk) AS kk FROM fx_p WHERE trim(phrase) <> '' GROUP BY ALL),
fx_b AS (SELECT doc_id, k, phrase, j, CASE WHEN (doc_id + k) % 23 = 0 THEN [0.0, 0.0, 640.0, 480.0]::DOUBLE[] ELSE
  [CASE WHEN (doc_id + k) % 29 = 0 THEN 0 ELSE (37 * doc_id + 53 * kk + 101 * (j // 2)) % 500 + j % 2 END, (41 * doc_id + 29 * kk + 67 * (j // 2)) % 380,
   CASE WHEN (doc_id + k) % 29 = 0 THEN 10 ELSE least(640, (37 * doc_id + 53 * kk + 101 * (j // 2)) % 500 + j % 2 + 8 + (13 * doc_id + 17 * kk + 31 * (j // 2)) % 220) END,
   least(480, (41 * doc_id + 29 * kk + 67 * (j // 2)) % 380 + 8 + (11 * doc_id + 23 * kk) % 150)]::DOUBLE[] END AS box
  FROM (SELECT *, unnest(range(0, 1 + (doc_id + kk) % 3)) AS j FROM fx_n)),
fx_g AS (SELECT doc_id, k, phrase, list(box ORDER BY j) AS boxes FROM fx_b GROUP BY ALL),
fx AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1 AS k, phrase, boxes FROM fx_g)
"""


def cleaned(name: str | Profile, p: str = "") -> str:
    """CTEs {p}cells (doc_id, k, phrase, norm, cw, rule, by, raw, n_<rule>) and {p}kept
    (doc_id, k, phrase, boxes), after FIXTURE."""
    f = PROFILES[name] if isinstance(name, str) else name
    case = []
    if f.vague:
        case.append(("vague", vague("phrase")))
    if f.abstract:
        case.append(("abstract", f"len(cw) > 0 AND (cw[-1] IN ({quoted(ABSTRACT_HEADS)}) OR norm IN ({quoted(SHOT_PHRASES)}))"))
    if f.garbled:
        hit = "contains(' ' || cap || ' ', ' ' || norm || ' ')" if f.whole_words else "contains(cap, norm)"
        case.append(("garbled", f"cap <> '' AND norm <> '' AND NOT {hit}"))
    case.append(("words", f"len(cw) < {f.min_words}"))
    if f.max_boxes:
        case.append(("nbox", f"len(raw) > {f.max_boxes}"))
    rule = "CASE " + " ".join(f"WHEN {t} THEN '{n}'" for n, t in case) + " END"
    w, h, a = "abs(b[3] - b[1])", "abs(b[4] - b[2])", "(b[3] - b[1]) * (b[4] - b[2]) / 307200"
    steps = [("dup", dedup("{x}"))] if f.dup else []
    keep = lambda test: "list_filter({x}, lambda b: " + test + ")"
    if f.min_area:
        steps.append(("area", keep(f"{a} >= {f.min_area}::DOUBLE")))
    if f.min_px:
        steps.append(("minpx", keep(f"least({w}, {h}) >= {f.min_px}::DOUBLE")))
    if f.max_ratio:
        steps.append(("ratio", keep(f"least({w}, {h}) > 0 AND greatest({w}, {h}) / least({w}, {h}) <= {f.max_ratio}::DOUBLE")))
    if f.max_cover:
        steps.append(("fullimg", keep(f"{a} <= {f.max_cover}::DOUBLE")))
    if f.edge:
        steps.append(("edge", keep(f"NOT ((b[1] <= 2 OR b[2] <= 2 OR b[3] >= 638 OR b[4] >= 478) AND ({w} <= 640 * 0.06::DOUBLE OR {h} <= 480 * 0.06::DOUBLE))")))
    out = [f"{p}c0 AS (SELECT doc_id, k, trim(phrase) AS phrase, boxes AS raw, cap FROM fx JOIN docs USING (doc_id))", f"{p}c1 AS (SELECT *, {norm('phrase')} AS norm FROM {p}c0)", f"{p}c2 AS (SELECT *, {content('norm')} AS cw FROM {p}c1)", f"{p}s0 AS (SELECT *, {rule} AS rule0, CASE WHEN {rule} IS NULL THEN raw END AS x0 FROM {p}c2)"]
    for i, (n, step) in enumerate(steps):
        out.append(f"{p}s{i + 1} AS (SELECT *, {step.format(x=f'x{i}')} AS x{i + 1} FROM {p}s{i})")
    m = len(steps)
    size = lambda i: f"coalesce(len(x{i}), 0)"
    counts = {n: f"CAST({size(i)} - {size(i + 1)} AS BIGINT)" for i, (n, _) in enumerate(steps)}
    by = "CASE " + " ".join(f"WHEN len(x{i + 1}) = 0 THEN '{n}'" for i, (n, _) in enumerate(steps)) + " END" if steps else "NULL"
    every = ", ".join(f"{counts.get(n, 'CAST(0 AS BIGINT)')} AS n_{n}" for n in ("dup", "area", "minpx", "ratio", "fullimg", "edge"))
    out.append(f"{p}e AS (SELECT doc_id, k, phrase, norm, cw, raw, CASE WHEN rule0 IS NULL AND len(x{m}) = 0 THEN 'empty' ELSE rule0 END AS rule1, CASE WHEN rule0 IS NULL AND len(x{m}) = 0 THEN {by} END AS blamed, x{m} AS boxes, {every} FROM {p}s{m})")
    out.append(f"{p}v AS (SELECT doc_id, phrase, min(k) AS k, arg_max(boxes, k) AS boxes, arg_min(cw, k) AS cw FROM {p}e WHERE rule1 IS NULL GROUP BY doc_id, phrase)")
    if f.xdup:
        out.append(f"{p}x0 AS (SELECT *, array_to_string(list_sort(list_distinct(cw)), ' ') AS key FROM {p}v)")
        out.append(f"{p}x1 AS (SELECT doc_id, key, min(k) AS gk, list({{'k': k, 'phrase': phrase, 'boxes': boxes}} ORDER BY -len(cw), -length(phrase), k) AS es FROM {p}x0 GROUP BY ALL)")
        taken = f"len(list_filter(e[1].boxes, lambda b: len(list_filter(flatten(list_transform(acc, lambda y: y.boxes)), lambda q: {iou('b', 'q')} > 0.9)) > 0)) > 0"
        out.append(f"{p}x2 AS (SELECT doc_id, gk, list_reduce(list_transform(es, lambda e: [e]), lambda acc, e: CASE WHEN {taken} THEN acc ELSE list_concat(acc, e) END) AS es FROM {p}x1)")
        out.append(f"{p}x3 AS (SELECT doc_id, gk, unnest(range(1, len(es) + 1)) AS i, es FROM {p}x2)")
        out.append(f"{p}kept AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY gk, i) - 1 AS k, es[i].phrase AS phrase, es[i].boxes AS boxes FROM {p}x3)")
    else:
        out.append(f"{p}kept AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1 AS k, phrase, boxes FROM {p}v)")
    out.append(f"{p}cells AS (SELECT e.* EXCLUDE (rule1), CASE WHEN rule1 IS NULL AND q.phrase IS NULL THEN 'xdup' ELSE rule1 END AS rule FROM {p}e e LEFT JOIN {p}kept q ON q.doc_id = e.doc_id AND q.phrase = e.phrase)")
    return ",\n".join(out)


FLAT = "SELECT doc_id, k, phrase, CAST(j - 1 AS BIGINT) AS j, boxes[j][1] AS x0, boxes[j][2] AS y0, boxes[j][3] AS x1, boxes[j][4] AS y1 FROM (SELECT *, unnest(range(1, len(boxes) + 1)) AS j FROM {p}kept)"

#: vf (doc_id, path, k, phrase, box, n_box, crop_frac, verdict), after cleaned("rec").
VERDICTS = f"""
vf AS (SELECT doc_id, 'doc/' || doc_id AS path, k, phrase, boxes[1] AS box, CAST(len(boxes) AS BIGINT) AS n_box,
  {rounded("(boxes[1][3] - boxes[1][1]) * (boxes[1][4] - boxes[1][2]) / 307200", 4)} AS crop_frac,
  CASE WHEN (7 * doc_id + 3 * k) % 20 = 0 THEN 'ERROR' WHEN (7 * doc_id + 3 * k) % 20 = 1 THEN 'TOO_SMALL' WHEN (7 * doc_id + 3 * k) % 20 = 2 THEN 'UNPARSED' WHEN (7 * doc_id + 3 * k) % 20 <= 8 THEN 'NO' ELSE 'YES' END AS verdict
  FROM kept WHERE k < 12)
"""
ANSWERS = """
an AS (SELECT *, verdict AS auto, CASE WHEN k % 11 = 0 THEN 'UNSURE' WHEN k % 7 = 0 THEN CASE WHEN verdict = 'YES' THEN 'NO' ELSE 'YES' END ELSE verdict END AS human
  FROM vf WHERE verdict IN ('YES', 'NO') QUALIFY row_number() OVER (PARTITION BY verdict ORDER BY md5(path || '|' || phrase || '|11'), path, phrase) <= 50)
"""


def rec(*more: str) -> str:
    return "WITH " + ",\n".join([FIXTURE, cleaned("rec"), *more])
