"""The registered queries as DuckDB SQL over the same tables."""

from __future__ import annotations

import re

from marginalia.functions.text import WHITESPACE_CHARS, WHITESPACE_RANGES
from marginalia.plans.catalog import PAD_LEFT, PAD_RIGHT
from marginalia.sources.annotated import REQUIRED_COLUMNS
from marginalia.sources.vocabulary import BUILT_IN_RULES, GOLD_ITEMS, LANGUAGE_RULES, SAMPLE_TEXTS

LABELS = list(LANGUAGE_RULES)
_ODD = re.escape(WHITESPACE_CHARS.replace(" ", ""))
_W = r"\p{L}\p{N}_"
_SPACE = "".join(
    f"\\x{{{lo:x}}}" if lo == hi else f"\\x{{{lo:x}}}-\\x{{{hi:x}}}" for lo, hi in WHITESPACE_RANGES
)


def q(text: str) -> str:
    """A SQL string expression; whitespace other than a space is spelled as chr()."""
    runs = re.findall(f"[{_ODD}]|[^{_ODD}]+", text) or [""]
    parts = [f"chr({ord(x)})" if re.fullmatch(f"[{_ODD}]", x) else "'" + x.replace("'", "''") + "'" for x in runs]
    return parts[0] if len(parts) == 1 else f"({' || '.join(parts)})"


def r(value: str, digits: int) -> str:
    """Correctly rounded decimal of the binary value (what Python's round gives)."""
    return f"(CAST(format('{{:.{digits}f}}', CAST({value} AS DOUBLE)) AS DOUBLE) + 0.0)"


def pct(part: str, whole: str, digits: int = 2) -> str:
    return r(f"CASE WHEN {whole} = 0 THEN 0 ELSE CAST({part} AS DOUBLE) / {whole} * 100 END", digits)


def strip(text: str) -> str:
    return f"trim({text}, {q(WHITESPACE_CHARS)})"


def normalise(text: str) -> str:
    return f"regexp_replace({strip(f'lower({text})')}, {q(f'[{_SPACE}]+')}, ' ', 'g')"


def found(text: str, pattern: str) -> str:
    """Case-insensitive search; word boundaries written out, as RE2's are ASCII only."""
    body = pattern.replace(r"\s", f"[{_SPACE}]").replace(r"\S", f"[^{_SPACE}]")
    start, end = f"(^|[^{_W}])", f"([^{_W}]|$)"
    shape = re.fullmatch(r"\\b(.*)\\b", body)
    if not shape:
        return f"regexp_matches({text}, {q(body)}, 'i')"
    inner, extra = shape[1], ""
    if r"18\+" in inner:  # ends in a non-word character, so the boundary asks for a word after it
        inner = inner.replace(r"|18\+", "")
        extra = f" OR regexp_matches({text}, {q(start + '18[+][' + _W + ']')}, 'i')"
    return f"(regexp_matches({text}, {q(start + inner + end)}, 'i'){extra})"


def count_of(text: str, patterns: list[str]) -> str:
    return "(" + " + ".join(f"CAST({found(text, p)} AS INTEGER)" for p in patterns) + ")"


def argmax(rules: dict[str, list[str]], prefix: str = "c") -> str:
    """Most patterns; first declared on ties; last declared where none matched."""
    names = [f"{prefix}{i}" for i in range(len(rules))]
    branches = [f"WHEN {' + '.join(names)} = 0 THEN {q(list(rules)[-1])}"]
    for i, label in enumerate(rules):
        later = [f"{names[i]} >= {n}" for n in names[i + 1 :]]
        branches.append(f"WHEN {' AND '.join(later) or 'TRUE'} THEN {q(label)}")
    return "CASE " + " ".join(branches) + " END"


def share(rules: dict[str, list[str]], label: str, prefix: str = "c") -> str:
    """Matched / declared patterns of the winner."""
    branches = [
        f"WHEN {q(name)} THEN CAST({prefix}{i} AS DOUBLE) / {len(ps)}"
        for i, (name, ps) in enumerate(rules.items())
    ]
    return r(f"CASE {label} {' '.join(branches)} END", 4)


def prediction(rules: dict[str, list[str]], source: str, text: str, columns: str) -> str:
    """A sub-select: columns, counts c0.., auto_label, auto_confidence."""
    counts = ", ".join(f"{count_of(text, ps)} AS c{i}" for i, ps in enumerate(rules.values()))
    return (
        f"SELECT *, {share(rules, 'auto_label')} AS auto_confidence FROM ("
        f"SELECT *, {argmax(rules)} AS auto_label FROM (SELECT {columns}, {counts} FROM {source}))"
    )


_LANG_ORD = "CASE lang " + " ".join(f"WHEN {q(x)} THEN '{i + 1}'" for i, x in enumerate(LABELS)) + " END"
_SIGNALS = ", ".join(f"c{i} AS signal_{x}" for i, x in enumerate(LABELS))

PRED = f"""pred AS ({prediction(LANGUAGE_RULES, 'documents', 'text',
    'doc_id, CAST(doc_id AS VARCHAR) AS _id, text, lang, source, n_chars')})"""

DECISIONS = f"""dec AS (
  SELECT CAST(doc_id AS VARCHAR) AS source_id, source AS annotator, doc_id AS seq, n_chars / 100.0 AS time_sec,
    CASE WHEN n_chars > 10000 THEN 'q' WHEN quality = 0 AND toxic = 1 THEN 'x' WHEN quality = 0 THEN ' S '
         WHEN toxic = 1 THEN '' ELSE {_LANG_ORD} END AS choice
  FROM documents JOIN labels USING (doc_id)),
alive AS (
  SELECT source_id, annotator, CAST(time_sec AS DOUBLE) AS time_sec, trim(lower(choice)) AS choice FROM dec
  WHERE trim(lower(choice)) IN ('', 's', '1', '2', '3', '4')
    AND seq < coalesce((SELECT min(e.seq) FROM dec e WHERE e.annotator = dec.annotator AND e.choice = 'q'),
                       9223372036854775807))"""

_CHOSEN = "CASE a.choice " + " ".join(f"WHEN '{i + 1}' THEN {q(x)}" for i, x in enumerate(LABELS))
REC = f"""{PRED}, {DECISIONS}, rec AS (
  SELECT *, is_human_reviewed AND final_label <> auto_label AS human_override FROM (
    SELECT p.*, p._id AS source_id, a.source_id IS NOT NULL AS is_human_reviewed,
      CASE WHEN a.source_id IS NULL THEN p.auto_label ELSE {_CHOSEN} ELSE p.auto_label END END AS final_label,
      coalesce(a.annotator, 'auto') AS annotator, {r('coalesce(a.time_sec, 0)', 3)} AS annotation_time_sec
    FROM pred p LEFT JOIN alive a ON p._id = a.source_id))"""

GOLD = """gold AS (SELECT CAST(doc_id AS VARCHAR) AS source_id, lang AS final_label
  FROM documents JOIN labels USING (doc_id) WHERE quality = 1)"""

_SUMMARY = f"""count(*) AS total_records, 'language' AS task,
  {', '.join(f"count(*) FILTER (WHERE final_label = {q(x)}) AS final_{x}" for x in LABELS)},
  {', '.join(f"count(*) FILTER (WHERE auto_label = {q(x)}) AS auto_{x}" for x in LABELS)}"""
_CONF_STATS = f"""{r('avg(auto_confidence)', 4)} AS mean, {r('median(auto_confidence)', 4)} AS median,
  {r('min(auto_confidence)', 4)} AS min, {r('max(auto_confidence)', 4)} AS max,
  {pct('count(*) FILTER (WHERE auto_confidence = 0)', 'count(*)')} AS pct_zero"""
_REVIEW_STATS = f"""count(*) FILTER (WHERE is_human_reviewed) AS reviewed_count,
  count(*) FILTER (WHERE human_override) AS override_count,
  {pct('count(*) FILTER (WHERE human_override)', 'count(*) FILTER (WHERE is_human_reviewed)')}
    AS override_rate_pct"""
_FLAGS = """count(*) FILTER (WHERE auto_confidence > 0 AND auto_confidence < 0.2) AS low_confidence_count,
  count(*) FILTER (WHERE auto_confidence = 0) AS zero_signal_count,
  count(*) FILTER (WHERE auto_confidence < 0.2) AS needs_human_review"""
_SUMMARY_ALL = f"SELECT {_SUMMARY}, {_CONF_STATS}, {_REVIEW_STATS}, {_FLAGS} FROM rec"

_KAPPA_BANDS = """CASE WHEN {k} < 0 THEN 'Poor (worse than chance)' WHEN {k} < 0.2 THEN 'Slight'
  WHEN {k} < 0.4 THEN 'Fair' WHEN {k} < 0.6 THEN 'Moderate' WHEN {k} < 0.8 THEN 'Substantial'
  ELSE 'Almost Perfect' END"""


def commas(n: str) -> str:
    return f"format('{{:,}}', CAST({n} AS BIGINT))"


def number(value: str) -> str:
    """A double as text with at least one decimal."""
    return f"CAST(CAST({value} AS DOUBLE) AS VARCHAR)"


def issue_list(*lines: str) -> str:
    return f"concat_ws('; ', {', '.join(lines)})"


# --- checks, as sub-selects over a relation ------------------------------------------------

_MISSING = "coalesce({c}, '') IN ('', 'nan', 'None', 'null')"


def completeness(src: str) -> str:
    return f"""SELECT 'Completeness' AS "check", *, missing_labels = 0 AND empty_text = 0 AS passed,
      {r('CASE WHEN total_records = 0 THEN 0 ELSE (1 - CAST(missing_labels + empty_text AS DOUBLE) / total_records) * 100 END', 2)}
        AS completeness_pct,
      {issue_list(*[f"CASE WHEN {c} > 0 THEN {commas(c)} || ' records {m}' END" for c, m in [
          ('missing_labels', 'have no final_label'), ('empty_text', 'have empty text'),
          ('missing_confidence', 'missing confidence score'), ('missing_auto_labels', 'have no auto_label')]])}
        AS issues
    FROM (SELECT count(*) AS total_records,
      count(*) FILTER (WHERE {_MISSING.format(c='final_label')}) AS missing_labels,
      count(*) FILTER (WHERE {strip('text')} = '') AS empty_text,
      count(*) FILTER (WHERE isnan(auto_confidence)) AS missing_confidence,
      count(*) FILTER (WHERE {_MISSING.format(c='auto_label')}) AS missing_auto_labels FROM {src})"""


def confidence(src: str, threshold: float) -> str:
    c = "auto_confidence"
    return f"""SELECT 'Confidence Analysis' AS "check", CAST({threshold} AS DOUBLE) AS threshold, * EXCLUDE (n),
      needs_review_pct < 30 AS passed,
      CASE WHEN needs_review_count > 0 THEN {commas('needs_review_count')} || ' items (' ||
        {number('needs_review_pct')} || '%) below confidence threshold {threshold:.0%}' ELSE '' END AS issues
    FROM (SELECT *, {pct('needs_review_count', 'n')} AS needs_review_pct FROM (SELECT count(*) AS n,
      {r(f'avg({c})', 4)} AS mean, {r(f'median({c})', 4)} AS median, {r(f'stddev_samp({c})', 4)} AS std,
      {r(f'min({c})', 4)} AS min, {r(f'max({c})', 4)} AS max,
      count(*) FILTER (WHERE {c} = 0) AS zero,
      count(*) FILTER (WHERE {c} > 0 AND {c} < {threshold}) AS very_low,
      count(*) FILTER (WHERE {c} >= 0.2 AND {c} < 0.4) AS low,
      count(*) FILTER (WHERE {c} >= 0.4 AND {c} < 0.7) AS medium,
      count(*) FILTER (WHERE {c} >= 0.7) AS high,
      count(*) FILTER (WHERE {c} < {threshold}) AS needs_review_count
      FROM (SELECT CAST(auto_confidence AS DOUBLE) AS auto_confidence FROM {src}) WHERE NOT isnan({c})))"""


def label_check(src: str) -> str:
    """src: relation with final_label and auto_label."""
    return f"""SELECT 'Label Distribution' AS "check", count(*) AS n_classes,
      {r('CASE WHEN count(*) > 1 THEN (2 * list_sum(list(i * (CAST(n AS DOUBLE) / total) ORDER BY i)) - (count(*) + 1)) / count(*) ELSE 0 END', 4)}
        AS gini_coefficient,
      {pct('sum(agree)', 'sum(n)')} AS auto_final_agreement_pct,
      count(*) FILTER (WHERE share > 500.0 / k) AS imbalance_flags,
      count(*) FILTER (WHERE share > 500.0 / k) = 0 AND
        (CASE WHEN count(*) > 1 THEN (2 * list_sum(list(i * (CAST(n AS DOUBLE) / total) ORDER BY i)) - (count(*) + 1)) / count(*) ELSE 0 END) < 0.6
        AS passed,
      coalesce(string_agg(CASE WHEN share > 500.0 / k THEN '''' || label || ''' is heavily dominant (' ||
        format('{{:.1f}}', share) || '% vs expected ' || format('{{:.1f}}', 100.0 / k) || '%)' END, '; ' ORDER BY n DESC), '')
        AS issues
    FROM (SELECT *, CAST(n AS DOUBLE) / total * 100 AS share FROM (SELECT label, n, agree, sum(n) OVER () AS total,
        count(*) OVER () AS k, row_number() OVER (ORDER BY n, label) AS i
      FROM (SELECT final_label AS label, count(*) AS n, count(*) FILTER (WHERE auto_label = final_label) AS agree
        FROM {src} GROUP BY 1)))"""


def duplicate_check(src: str) -> str:
    return f"""SELECT 'Duplicate Detection' AS "check", exact_duplicates, {pct('exact_duplicates', 'n')} AS duplicate_pct,
      least(conflicts, 5) AS label_conflicts, conflicts AS label_conflicts_total, exact_duplicates = 0 AS passed,
      CASE WHEN exact_duplicates > 0 THEN {commas('exact_duplicates')} || ' duplicate texts found (' ||
        conflicts || ' with conflicting labels)' ELSE '' END AS issues
    FROM (SELECT CAST(sum(c) AS BIGINT) AS n, CAST(coalesce(sum(c) FILTER (WHERE c > 1), 0) AS BIGINT) AS exact_duplicates,
        count(*) FILTER (WHERE l > 1) AS conflicts
      FROM (SELECT count(*) AS c, count(DISTINCT final_label) AS l FROM {src} GROUP BY {normalise('text')}))"""


_SHOUT = r"regexp_matches({t}, '\p{{Lu}}') AND NOT regexp_matches({t}, '[\p{{Ll}}\p{{Lt}}]') AND length({s}) > 10"


def shouting(text: str) -> str:
    return "(" + _SHOUT.format(t=text, s=strip(text)) + ")"


def text_quality(src: str) -> str:
    issues = issue_list(
        f"CASE WHEN too_short > 0 THEN {commas('too_short')} || ' texts under 5 characters' END",
        f"CASE WHEN too_long > 0 THEN {commas('too_long')} || ' texts over 5,000 characters' END",
        f"CASE WHEN encoding_issues > 0 THEN {commas('encoding_issues')} || ' texts with encoding issues (U+FFFD)' END",
    )
    return f"""SELECT 'Text Quality' AS "check", *,
      too_short = 0 AND too_long = 0 AND encoding_issues = 0 AS passed, {issues} AS issues
    FROM (SELECT {r('avg(length(text))', 1)} AS mean_length, {r('median(length(text))', 1)} AS median_length,
      min(length(text)) AS min_length, max(length(text)) AS max_length,
      count(*) FILTER (WHERE length(text) < 5) AS too_short,
      count(*) FILTER (WHERE length(text) > 5000) AS too_long,
      count(*) FILTER (WHERE contains(text, '�')) AS encoding_issues,
      count(*) FILTER (WHERE {shouting('text')}) AS all_caps,
      count(*) FILTER (WHERE regexp_matches(text, '[!?]{{3,}}')) AS excess_punctuation FROM {src})"""


_BANDS = [("0_20", 0, 0.2, "0%–20%"), ("20_40", 0.2, 0.4, "20%–40%"), ("40_70", 0.4, 0.7, "40%–70%"), ("70_up", 0.7, 1.01, "≥70%")]


def overrides_check(src: str) -> str:
    bands = []
    for slug, lo, hi, _ in _BANDS:
        inside = f"auto_confidence >= {lo} AND auto_confidence < {hi}"
        reviewed = f"count(*) FILTER (WHERE {inside})"
        overridden = f"count(*) FILTER (WHERE {inside} AND human_override)"
        bands += [
            f"CAST(nullif({reviewed}, 0) AS DOUBLE) AS reviewed_{slug}",
            f"CASE WHEN {reviewed} > 0 THEN CAST({overridden} AS DOUBLE) END AS overrides_{slug}",
            f"CASE WHEN {reviewed} > 0 THEN {pct(overridden, reviewed)} END AS override_rate_{slug}",
        ]
    worst = f"""(SELECT auto_label FROM {src} WHERE is_human_reviewed GROUP BY 1
      ORDER BY count(*) FILTER (WHERE human_override) DESC, auto_label LIMIT 1)"""
    return f"""SELECT 'Override Analysis' AS "check", *, overall_override_rate_pct < 25 AS passed,
      CASE WHEN overall_override_rate_pct > 25 THEN 'High override rate ' || {number('overall_override_rate_pct')} ||
        '% — consider improving rules for ''' || {worst} || '''' ELSE '' END AS issues
    FROM (SELECT count(*) AS human_reviewed, count(*) FILTER (WHERE human_override) AS overrides,
      {pct('count(*) FILTER (WHERE human_override)', 'count(*)')} AS overall_override_rate_pct, {', '.join(bands)}
      FROM {src} WHERE is_human_reviewed)"""


def prf(pairs: str) -> str:
    """pairs: relation with auto (automatic label) and truth (gold label)."""
    p, rc = "coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0)", "coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0)"
    return f"""SELECT label, tp, fp, fn, {r(p, 4)} AS precision, {r(rc, 4)} AS recall,
      {r(f'coalesce(2 * {p} * {rc} / nullif({p} + {rc}, 0), 0)', 4)} AS f1, tp + fn AS support
    FROM (SELECT label, count(*) FILTER (WHERE auto = label AND truth = label) AS tp,
        count(*) FILTER (WHERE auto = label AND truth <> label) AS fp,
        count(*) FILTER (WHERE auto <> label AND truth = label) AS fn
      FROM {pairs}, (SELECT auto AS label FROM {pairs} UNION SELECT truth FROM {pairs}) GROUP BY 1)"""


def golden_check(pairs: str) -> str:
    accuracy = pct(f"(SELECT count(*) FILTER (WHERE auto = truth) FROM {pairs})", f"(SELECT count(*) FROM {pairs})")
    return f"""SELECT 'Golden Set Validation' AS "check", *, accuracy_pct >= 70 AS passed,
      CASE WHEN accuracy_pct < 70 THEN 'Accuracy ' || {number('accuracy_pct')} || '% below 70% target' ELSE '' END AS issues
    FROM (SELECT (SELECT count(*) FROM {pairs}) AS n_validated, {accuracy} AS accuracy_pct,
      {r('list_sum(list(f1 ORDER BY label)) / count(*)', 4)} AS macro_f1 FROM ({prf(pairs)}))"""


def kappa(pairs: str, by: str = "") -> str:
    """One row (or one per ``by``) with n and kappa over pairs(a, b)."""
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    joined = f"USING ({by}, label)" if by else "USING (label)"
    link = f"USING ({by})" if by else "ON TRUE"
    chance = f"""(SELECT {keys}sum(CAST(x.n AS DOUBLE) * y.n) AS e FROM
        (SELECT {keys}a AS label, count(*) AS n FROM {pairs} GROUP BY ALL) x JOIN
        (SELECT {keys}b AS label, count(*) AS n FROM {pairs} GROUP BY ALL) y {joined} {group})"""
    return f"""SELECT {keys}n, {r('''CASE WHEN 1 - coalesce(e, 0) / (CAST(n AS DOUBLE) * n) > 0 THEN
        (CAST(o AS DOUBLE) / n - coalesce(e, 0) / (CAST(n AS DOUBLE) * n)) / (1 - coalesce(e, 0) / (CAST(n AS DOUBLE) * n))
        ELSE 1 END''', 4)} AS kappa
    FROM (SELECT {keys}count(*) AS n, count(*) FILTER (WHERE a = b) AS o FROM {pairs} {group}) LEFT JOIN {chance} {link}"""


def agreement_check(pairs: str) -> str:
    return f"""SELECT 'Inter-Annotator Agreement' AS "check", n AS shared_items, {pct('o', 'n')} AS exact_agreement_pct,
      kappa AS cohens_kappa, n - o AS disagreement_count, kappa >= 0.6 AS passed,
      {_KAPPA_BANDS.format(k='kappa')} AS kappa_interpretation,
      CASE WHEN kappa < 0.6 THEN 'Kappa=' || format('{{:.3f}}', kappa) || ' (' || {_KAPPA_BANDS.format(k='kappa')} ||
        ') — target ≥ 0.60' ELSE '' END AS issues
    FROM ({kappa(pairs)}), (SELECT count(*) FILTER (WHERE a = b) AS o FROM {pairs})"""


# relations used by several checks
AUTO_GOLD = "ag AS (SELECT p.auto_label AS auto, g.final_label AS truth FROM pred p JOIN gold g ON p._id = g.source_id)"
REC_GOLD = AUTO_GOLD.replace("pred p", "rec p")
AUTO_LANG = "al AS (SELECT auto_label AS a, lang AS b FROM pred)"
FINAL_LANG = "al AS (SELECT final_label AS a, lang AS b FROM rec)"
_SUITE_CTE = f"WITH {REC}, {GOLD}, {REC_GOLD}, {FINAL_LANG}"
_SUITE = {
    1: completeness("rec"),
    2: confidence("rec", 0.2),
    3: label_check("rec"),
    4: duplicate_check("rec"),
    5: text_quality("rec"),
    6: overrides_check("rec"),
    7: golden_check("ag"),
    8: agreement_check("al"),
}
_SUITE_ROWS = " UNION ALL ".join(
    f"""SELECT {i} AS ord, "check", passed, FALSE AS skipped, issues FROM ({sql})""" for i, sql in _SUITE.items()
)

_DIGESTS = "SELECT CAST(doc_id AS VARCHAR) AS id, lang, length(text) AS n_chars, md5(text) AS text_md5 FROM documents"
_PADDED = strip(f"({q(PAD_LEFT)} || text || {q(PAD_RIGHT)})")
_DOCS_CLEAN = "SELECT CAST(doc_id AS VARCHAR) AS _id{more}, md5({t}) AS text_md5 FROM documents".replace(
    "{t}", strip("text")
)


def _task_counts(task: str, rules: dict[str, list[str]], source: str, with_confidence: bool) -> str:
    more = ", auto_confidence" if with_confidence else ""
    inner = prediction(rules, source, "text", "text")
    return f"SELECT {q(task)} AS task, auto_label{more}, count(*) AS n FROM ({inner}) GROUP BY ALL"


def _flat_text(sql: str) -> str:
    return re.sub(r"\s*\n\s*", " ", sql).strip()


def _damaged() -> str:
    return """dam AS (SELECT CASE WHEN source = 'src4' THEN ' ' || chr(9) ELSE text END AS text,
      CASE WHEN source = 'src5' THEN 'null' ELSE auto_label END AS final_label,
      CASE WHEN source = 'src6' THEN '' ELSE auto_label END AS auto_label,
      CASE WHEN source = 'src7' THEN CAST('nan' AS DOUBLE) ELSE auto_confidence END AS auto_confidence FROM pred)"""


def _report() -> str:
    """The report rows, section by section."""
    verdict = "CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END"
    none_t, none_d = "CAST(NULL AS VARCHAR)", "CAST(NULL AS DOUBLE)"
    sections = {
        1: {"stats": ["total_records", "completeness_pct"],
            "flags": ["missing_labels", "empty_text", "missing_confidence", "missing_auto_labels"]},
        2: {"stats": ["threshold", "mean", "median", "std", "min", "max", "needs_review_count", "needs_review_pct"],
            "buckets": ["zero", "very_low", "low", "medium", "high"]},
        3: {"stats": ["n_classes", "gini_coefficient", "auto_final_agreement_pct", "imbalance_flags"]},
        4: {"stats": ["exact_duplicates", "duplicate_pct", "label_conflicts", "label_conflicts_total"]},
        5: {"stats": ["mean_length", "median_length", "min_length", "max_length"],
            "flags": ["too_short", "too_long", "encoding_issues", "all_caps", "excess_punctuation"]},
        6: {"stats": ["human_reviewed", "overrides", "overall_override_rate_pct"],
            "by_confidence_band": [f"{w}_{b[0]}" for b in _BANDS for w in ("reviewed", "overrides", "override_rate")]},
        7: {"stats": ["n_validated", "accuracy_pct", "macro_f1"]},
        8: {"stats": ["shared_items", "exact_agreement_pct", "cohens_kappa", "disagreement_count"]},
    }
    parts = [
        f"""SELECT 'overall' AS section, 'status' AS item, 'status' AS metric,
          CASE WHEN count(*) FILTER (WHERE NOT passed) = 0 THEN 'PASS' ELSE 'FAIL' END AS text, {none_d} AS value FROM checks""",
        f"""SELECT 'overall', 'checks', m, {none_t}, CAST(v AS DOUBLE) FROM (SELECT unnest(['n_pass', 'n_fail', 'n_skip']) AS m,
          unnest([count(*) FILTER (WHERE passed), count(*) FILTER (WHERE NOT passed), 0]) AS v FROM checks)""",
        f"""SELECT 'labels', final_label, 'count', {none_t}, CAST(count(*) AS DOUBLE) FROM rec GROUP BY final_label""",
        f"""SELECT 'labels', final_label, 'pct', {none_t}, {pct('count(*)', '(SELECT count(*) FROM rec)', 1)} FROM rec
          GROUP BY final_label""",
        f"""SELECT 'checks', "check", 'verdict', {verdict}, {none_d} FROM checks""",
        f"""SELECT 'checks', "check", 'issue', unnest(string_split(issues, '; ')), {none_d} FROM checks WHERE issues <> ''""",
    ]
    for i, groups in sections.items():
        for section, metrics in groups.items():
            for m in metrics:
                parts.append(
                    f"""SELECT 'figures', "check", {q(m)}, {q(section)}, {r(f'"{m}"', 4)} FROM s{i} WHERE "{m}" IS NOT NULL"""
                )
    details = [
        ("'Label Distribution: ' || final_label", "count", "distribution", "CAST(count(*) AS DOUBLE)", "rec GROUP BY final_label"),
        ("'Label Distribution: ' || final_label", "pct", "distribution", pct("count(*)", "(SELECT count(*) FROM rec)"),
         "rec GROUP BY final_label"),
    ]
    for direction, column in (("from", "auto_label"), ("to", "final_label")):
        details.append(
            (f"'Override Analysis: {direction}: ' || {column}", "count", "from_to", "CAST(n AS DOUBLE)",
             f"(SELECT {column}, count(*) AS n FROM rec WHERE human_override GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5)")
        )
    for m in ("precision", "recall", "f1", "support"):
        details.append(("'Golden Set Validation: ' || label", m, "per_label", f"CAST({m} AS DOUBLE)", f"({prf('ag')})"))
    details.append(
        ("'Inter-Annotator Agreement: ' || a || ' / ' || b", "count", "top_conflicts", "CAST(n AS DOUBLE)",
         "(SELECT a, b, count(*) AS n FROM al WHERE a <> b GROUP BY ALL ORDER BY n DESC, a, b LIMIT 5)")
    )
    parts += [
        f"SELECT 'details', {item}, {q(metric)}, {q(section)}, {value} FROM {source}"
        for item, metric, section, value, source in details
    ]
    ctes = ", ".join(f"s{i} AS ({sql})" for i, sql in _SUITE.items())
    return f"{_SUITE_CTE}, {ctes}, checks AS ({_SUITE_ROWS}) " + " UNION ALL ".join(parts)


def _near_ctes() -> str:
    """Per document its key and shingles; pairs of similar different keys by counting common shingles."""
    return f"""k AS (SELECT doc_id, {normalise("coalesce(text, '')")} AS norm FROM documents),
      w AS (SELECT norm, list_filter(string_split(norm, ' '), lambda x: x <> '') AS ws FROM (SELECT DISTINCT norm FROM k)),
      sh AS (SELECT norm, unnest(CASE WHEN len(ws) = 0 THEN []::VARCHAR[] ELSE list_distinct(list_transform(
        range(0, greatest(len(ws) - 5, 0) + 1), lambda i: array_to_string(ws[i + 1:i + 5], ' '))) END) AS s FROM w),
      n AS (SELECT norm, count(*) AS n FROM sh GROUP BY norm),
      c AS (SELECT norm, min(doc_id) AS class_id, count(*) AS copies FROM k GROUP BY norm),
      o AS (SELECT a.norm AS a, b.norm AS b, count(*) AS overlap FROM sh a JOIN sh b ON a.s = b.s AND a.norm < b.norm GROUP BY 1, 2),
      pairs AS (SELECT a, b, overlap, x.n + y.n - overlap AS union_size FROM o JOIN n x ON x.norm = a JOIN n y ON y.norm = b
        WHERE 100 * overlap >= 80 * (x.n + y.n - overlap)),
      near AS (SELECT k.doc_id, class_id, copies, coalesce(n.n, 0) AS n_shingles,
          coalesce(m.n_near, 0) AS n_near FROM k JOIN c USING (norm) LEFT JOIN n USING (norm)
        LEFT JOIN (SELECT norm, count(*) AS n_near FROM (SELECT a AS norm FROM pairs UNION ALL SELECT b FROM pairs) GROUP BY norm) m
          USING (norm))"""


def _line_ctes() -> str:
    """Lines that are not blank, numbered; lines of ten documents; runs of those."""
    return f"""raw AS (SELECT doc_id, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS line,
        unnest(string_split(coalesce(text, ''), chr(10))) AS raw FROM documents),
      l AS (SELECT doc_id, line, norm, row_number() OVER (PARTITION BY doc_id ORDER BY line) AS nth
        FROM (SELECT doc_id, line, {normalise('raw')} AS norm FROM raw) WHERE norm <> ''),
      f AS (SELECT norm FROM l GROUP BY norm HAVING count(DISTINCT doc_id) >= 10),
      runs AS (SELECT doc_id, min(line) AS start_line, max(line) AS end_line, count(*) AS n_lines FROM (
          SELECT doc_id, line, nth - row_number() OVER (PARTITION BY doc_id ORDER BY nth) AS run FROM l JOIN f USING (norm))
        GROUP BY doc_id, run),
      shares AS (SELECT doc_id, coalesce(any_value(t.n), 0) AS n_lines, CAST(coalesce(sum(runs.n_lines), 0) AS BIGINT) AS n_flagged,
          count(runs.n_lines) AS n_runs, coalesce(max(runs.n_lines), 0) AS longest_run
        FROM documents LEFT JOIN (SELECT doc_id, count(*) AS n FROM l GROUP BY doc_id) t USING (doc_id)
        LEFT JOIN runs USING (doc_id) GROUP BY doc_id)"""


def sql() -> dict[str, str]:
    samples = ", ".join(q(s) for s in SAMPLE_TEXTS["intent"])
    gold_rows = ", ".join(f"({q(i)}, {q(t)}, {q(x)})" for i, t, x in GOLD_ITEMS["content_category"])
    hits = " UNION ALL ".join(
        f"""SELECT {q(task)} AS task, {q(label)} AS label, {lo} AS label_ord, {so} AS signal_ord,
          count(*) FILTER (WHERE {found('text', p)}) AS hits FROM documents"""
        for task, rules in BUILT_IN_RULES.items()
        for lo, (label, ps) in enumerate(rules.items())
        for so, p in enumerate(ps)
    )
    queries = {
        "S1_scan_csv": _DIGESTS,
        "S1_scan_csv_splits": _DIGESTS,
        "S2_scan_tsv": _DIGESTS,
        "S3_scan_json_array": _DIGESTS,
        "S4_scan_jsonl": _DIGESTS,
        "S5_format_dispatch": """SELECT suffix, lang, count(*) AS n FROM documents,
          (SELECT unnest(['.csv', '.jsonl', '.parquet']) AS suffix) GROUP BY ALL""",
        "S6_scan_annotated": f"""WITH {REC} SELECT source_id, auto_label, auto_confidence, final_label, is_human_reviewed,
          human_override, md5(text) AS text_md5 FROM rec""",
        "S7_scan_rules": f"WITH {PRED} SELECT auto_label AS label, count(*) AS count FROM pred GROUP BY 1",
        "S8_builtin_rules": hits,
        "S9_gen_samples": f"""SELECT 'intent_' || CASE WHEN doc_id + 1 < 1000 THEN lpad(CAST(doc_id + 1 AS VARCHAR), 4, '0')
            ELSE CAST(doc_id + 1 AS VARCHAR) END AS id,
          list_extract([{samples}], CAST(doc_id % 15 + 1 AS INTEGER)) ||
            CASE WHEN doc_id >= 15 THEN ' (sample #' || (doc_id + 1) || ')' ELSE '' END AS text FROM documents""",
        "S10_golden_table": f"""SELECT source_id, g.text, final_label, count(*) AS n
          FROM (VALUES {gold_rows}) AS g(source_id, text, final_label)
          JOIN documents d ON source_id = 'g' || lpad(CAST(d.doc_id % 10 + 1 AS VARCHAR), 3, '0') GROUP BY ALL""",
        "K1_sink_csv": f"""WITH {REC} SELECT source_id, 'language' AS task, auto_label, auto_confidence, final_label, annotator,
          CASE WHEN is_human_reviewed THEN 'True' ELSE 'False' END AS is_human_reviewed,
          CASE WHEN human_override THEN 'True' ELSE 'False' END AS human_override,
          {_SIGNALS}, md5(text) AS text_md5 FROM rec""",
        "K2_sink_jsonl": f"""WITH {REC} SELECT source_id, auto_label, auto_confidence, final_label, is_human_reviewed,
          annotation_time_sec, {_SIGNALS}, md5(text) AS text_md5 FROM rec""",
        "K3_sink_label_studio": f"""WITH {REC} SELECT source_id AS id, md5(text) AS text_md5, 'language' AS task_type,
          'label' AS from_name, 'text' AS to_name, 'choices' AS type, final_label AS chosen,
          auto_confidence AS confidence, FALSE AS was_cancelled, annotation_time_sec AS lead_time,
          'rule_engine_v1.0.0' AS model_version, auto_confidence AS score, auto_label AS guessed FROM rec""",
        "K4_sink_summary": f"WITH {REC} {_SUMMARY_ALL}",
        "K5_export_dispatch": f"""WITH {PRED} SELECT output, auto_label, count(*) AS n FROM pred,
          (SELECT unnest(['records', 'csv', 'jsonl', 'review_tasks']) AS output) GROUP BY ALL""",
        "K6_sink_qa_results": f"""{_SUITE_CTE} SELECT "check", passed, skipped, 'documents' AS input FROM ({_SUITE_ROWS})""",
        "P1_detect_text_col": _DOCS_CLEAN.format(more=""),
        "P2_detect_id_col": _DOCS_CLEAN.format(more=", source"),
        "P3_clean_text": f"SELECT doc_id, md5({_PADDED}) AS text_md5, length({_PADDED}) AS n FROM documents",
        "P4_drop_empty": "SELECT CAST(doc_id AS VARCHAR) AS _id, lang FROM documents WHERE lang NOT IN ('de', 'fr')",
        "P5_coerce_confidence": """SELECT event_id, CASE WHEN event_type IN ('error', 'view', 'signup') THEN 0.0 ELSE value END
          AS confidence FROM events""",
        "P6_coerce_bool": "SELECT event_id, event_type IN ('error', 'view') AS flag FROM events",
        "P7_alias_columns": """SELECT doc_id AS source_id, lang AS final_label, source AS auto_label,
          CAST(0.5 AS DOUBLE) AS auto_confidence, md5(text) AS text_md5 FROM documents""",
        "P8_normalise_text": f"SELECT doc_id, md5({normalise('text')}) AS key_md5 FROM documents",
        "P9_record_fields": f"""WITH {PRED}, passed AS (SELECT *, CASE WHEN source IN ('src0', 'src1') THEN NULL
            WHEN source IN ('src2', 'src3') THEN '' ELSE lang END AS given FROM pred)
          SELECT sha256('language' || chr(31) || _id || chr(31) || source || chr(31) || text) AS record_id, _id AS source_id,
            coalesce(nullif(given, ''), auto_label) AS final_label, source <> 'src9' AS is_human_reviewed,
            source <> 'src9' AND given IS DISTINCT FROM auto_label AS human_override,
            {r('n_chars / 32.0', 3)} AS annotation_time_sec FROM passed""",
        "P10_record_dict": f"""WITH {REC} SELECT
          sha256('language' || chr(31) || source_id || chr(31) || annotator || chr(31) || text) AS record_id, source_id,
          md5(text) AS text, 'language' AS task, auto_label, auto_confidence,
          {" || ',' || ".join(f'CAST(c{i} AS VARCHAR)' for i in range(len(LABELS)))} AS auto_signals,
          final_label, annotator, is_human_reviewed, human_override, annotation_time_sec, TRUE AS created_at, 0 AS metadata
          FROM rec""",
        "P11_interpret_kappa": f"""SELECT {_KAPPA_BANDS.format(k='(value - 20.0) / 100.0')} AS reading, count(*) AS n
          FROM events GROUP BY 1""",
        "P12_is_upper": f"""SELECT doc_id, {shouting('t')} AS shouting FROM
          (SELECT doc_id, CASE WHEN lang = 'de' THEN upper(text) ELSE text END AS t FROM documents)""",
        "P13_excess_punct": """SELECT doc_id, regexp_matches(text || CASE WHEN lang = 'fr' THEN '?!?' ELSE '!!' END, '[!?]{3,}')
          AS excess FROM documents""",
        "P14_has_replacement_char": "SELECT doc_id, lang = 'es' OR contains(text, '�') AS broken FROM documents",
        "P15_text_length": "SELECT doc_id, length(text || '😊') AS n FROM documents",
        "R1_rule_resolve": " UNION ALL ".join(
            _task_counts(t, rules, "documents", False)
            for t, rules in [
                ("language", LANGUAGE_RULES),
                ("sentiment", BUILT_IN_RULES["sentiment"]),
                ("intent", BUILT_IN_RULES["intent"]),
            ]
        ),
        "R2_signal_counts": f"WITH {PRED} SELECT _id, {_SIGNALS} FROM pred",
        "R3_argmax_label": f"WITH {PRED} SELECT _id, auto_label FROM pred",
        "R4_confidence": f"WITH {PRED} SELECT _id, auto_confidence FROM pred",
        "R5_zero_signal_default": f"WITH {PRED} SELECT _id, auto_label FROM pred WHERE auto_confidence = 0",
        "R6_unknown_text": f"""WITH {PRED} SELECT _id, CASE WHEN lang IN ('de', 'fr') THEN 'Unknown' ELSE auto_label END AS auto_label,
          CASE WHEN lang IN ('de', 'fr') THEN 0.0 ELSE auto_confidence END AS auto_confidence,
          CASE WHEN lang IN ('de', 'fr') THEN 0 ELSE {len(LABELS)} END AS n_signals FROM pred""",
        "R7_label_batch": f"""WITH {PRED} SELECT
          sha256('language' || chr(31) || _id || chr(31) || 'auto' || chr(31) || text) AS record_id, _id AS source_id,
          'language' AS task, auto_label, auto_confidence, auto_label AS final_label, 'auto' AS annotator,
          FALSE AS is_human_reviewed, FALSE AS human_override FROM pred""",
        "R8_label_rules_table": " UNION ALL ".join(
            _task_counts(t, rules, "(SELECT text FROM documents UNION ALL SELECT text FROM conversations)", True)
            for t, rules in [*BUILT_IN_RULES.items(), ("language", LANGUAGE_RULES)]
        ),
        "H1_apply_reviews": f"""WITH {REC} SELECT source_id, auto_label, final_label, annotator, is_human_reviewed,
          annotation_time_sec FROM rec""",
        "H2_quit_remainder": f"""WITH {DECISIONS} SELECT dec.annotator, count(alive.source_id) AS counted,
          count(*) - count(alive.source_id) AS void FROM dec LEFT JOIN alive USING (source_id) GROUP BY 1""",
        "H3_override_flag": f"WITH {REC} SELECT source_id, auto_label, final_label FROM rec WHERE human_override",
        "H4_review_counts": f"""WITH {REC} SELECT count(*) AS total, count(*) FILTER (WHERE NOT is_human_reviewed) AS auto,
          count(*) FILTER (WHERE is_human_reviewed) AS human, count(*) FILTER (WHERE human_override) AS override,
          {pct('count(*) FILTER (WHERE human_override)', 'count(*) FILTER (WHERE is_human_reviewed)')}
            AS override_rate_pct FROM rec""",
        "H5_review_queue": f"WITH {PRED} SELECT _id, auto_label, auto_confidence FROM pred WHERE auto_confidence < 0.15",
        "J1_iaa_join": f"""WITH {PRED} SELECT _id AS source_id, auto_label AS final_label_a, lang AS final_label_b FROM pred""",
        "J1_iaa_join_repeated_ids": """SELECT a.event_type AS label_a,
          CASE WHEN b.value > 20 THEN b.event_type ELSE 'view' END AS label_b, count(*) AS n
          FROM events a JOIN events b USING (user_id) GROUP BY ALL""",
        "J2_golden_join": f"""WITH {PRED}, {GOLD} SELECT _id AS source_id, auto_label, auto_confidence,
          final_label AS golden_label FROM pred JOIN gold ON _id = source_id""",
        "A1_annotation_summary": f"WITH {REC} {_SUMMARY_ALL}",
        "A2_label_distribution": f"WITH {REC} SELECT final_label AS label, count(*) AS count FROM rec GROUP BY 1",
        "A3_auto_label_distribution": f"WITH {PRED} SELECT auto_label AS label, count(*) AS count FROM pred GROUP BY 1",
        "A4_confidence_stats": f"WITH {PRED} SELECT {_CONF_STATS} FROM pred",
        "A5_review_stats": f"WITH {REC} SELECT {_REVIEW_STATS} FROM rec",
        "A6_quality_flags": f"WITH {PRED} SELECT {_FLAGS} FROM pred",
        "A7_summary_view": f"""WITH {REC} SELECT final_label AS label, count(*) AS count,
          {pct('count(*)', '(SELECT count(*) FROM rec)', 1)} AS pct FROM rec GROUP BY 1""",
        "Q1_check_completeness": f"WITH {PRED}, {_damaged()} {completeness('dam')}",
        "Q2_check_confidence": f"WITH {PRED}, {_damaged()} {confidence('dam', 0.25)}",
        "Q2_check_confidence_values": confidence("(SELECT value / 500.0 AS auto_confidence FROM events)", 0.2),
        "Q3_check_label_distribution": f"WITH {REC} {label_check('rec')}",
        "Q3_check_label_distribution_sources": f"""SELECT * EXCLUDE (auto_final_agreement_pct) FROM ({label_check(
            "(SELECT CASE WHEN lang = 'en' THEN 'src0' ELSE source END AS final_label, '' AS auto_label FROM documents)")})""",
        "Q3_label_shares": f"""SELECT event_type AS label, count(*) AS count,
          {pct('count(*)', '(SELECT count(*) FROM events)')} AS pct FROM events GROUP BY 1""",
        "Q3a_gini": f"""SELECT n_classes, gini_coefficient FROM ({label_check(
            "(SELECT CAST(user_id AS VARCHAR) AS final_label, '' AS auto_label FROM events)")})""",
        "Q4_cohens_kappa": f"""WITH {PRED}, al AS (SELECT source, auto_label AS a, lang AS b FROM pred)
          {kappa('al', 'source')}""",
        "Q4a_confusion_matrix": f"""WITH {PRED} SELECT auto_label AS label_a,
          {', '.join(f"count(*) FILTER (WHERE lang = {q(x)}) AS {x}" for x in LABELS)} FROM pred GROUP BY 1""",
        "Q5_check_inter_annotator": f"WITH {PRED}, {AUTO_LANG} {agreement_check('al')}",
        "Q5a_top_conflicts": f"""WITH {PRED}, {AUTO_LANG} SELECT a AS final_label_a, b AS final_label_b, count(*) AS count
          FROM al WHERE a <> b GROUP BY ALL ORDER BY count DESC, a, b LIMIT 5""",
        "Q6_check_duplicates": duplicate_check("(SELECT text, source AS final_label FROM documents)"),
        "Q6a_duplicate_label_conflicts": f"""SELECT md5(k) AS key_md5, count(*) AS copies, count(DISTINCT source) AS labels
          FROM (SELECT {normalise('text')} AS k, source FROM documents) GROUP BY k
          HAVING count(DISTINCT source) > 1""",
        "Q6_duplicates_with_history": f"""SELECT sha256(k) AS digest, count(*) FILTER (WHERE third = 2) AS copies,
            count(*) FILTER (WHERE third < 2) AS earlier, count(DISTINCT source) AS labels, count(DISTINCT source) > 1 AS conflicting
          FROM (SELECT {normalise('text')} AS k, source, doc_id % 3 AS third FROM documents)
          GROUP BY k HAVING count(*) FILTER (WHERE third = 2) > 0""",
        "Q7_check_text_quality": text_quality("documents"),
        "Q8_check_golden_set": f"WITH {PRED}, {GOLD}, {AUTO_GOLD} {golden_check('ag')}",
        "Q8a_per_label_prf": f"WITH {PRED}, {GOLD}, {AUTO_GOLD} {prf('ag')}",
        "Q9_check_override_analysis": f"WITH {REC} {overrides_check('rec')}",
        "Q9a_override_by_band": f"""WITH {REC} SELECT CASE {' '.join(
            f"WHEN auto_confidence >= {lo} AND auto_confidence < {hi} THEN {q(name)}" for _, lo, hi, name in _BANDS)} END AS band,
          count(*) AS reviewed, count(*) FILTER (WHERE human_override) AS overrides,
          {pct('count(*) FILTER (WHERE human_override)', 'count(*)')} AS override_rate
          FROM rec WHERE is_human_reviewed GROUP BY 1""",
        "Q9b_override_from_to": f"""WITH {REC}
          SELECT 'from' AS direction, * FROM (SELECT auto_label AS label, count(*) AS count FROM rec WHERE human_override
            GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5)
          UNION ALL SELECT 'to', * FROM (SELECT final_label, count(*) FROM rec WHERE human_override
            GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5)""",
        "Q10_run_all_checks": f"{_SUITE_CTE} {_SUITE_ROWS}",
        "Q11_overall_verdict": f"""{_SUITE_CTE} SELECT CASE WHEN count(*) FILTER (WHERE NOT passed) = 0 THEN 'PASS' ELSE 'FAIL' END
            AS status, count(*) FILTER (WHERE passed) AS n_pass, count(*) FILTER (WHERE NOT passed) AS n_fail,
          count(*) FILTER (WHERE passed IS NULL) AS n_skip FROM ({_SUITE_ROWS})""",
        "Q12_qa_report_rows": _report(),
        "L1_limit_rows": f"""SELECT CAST(doc_id AS VARCHAR) AS _id, md5({strip('text')}) AS text_md5 FROM documents
          WHERE lang <> 'de' ORDER BY doc_id LIMIT 150""",
        "L2_topk_labels": "SELECT source AS label, count(*) AS count FROM documents GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5",
        "L3_sorted_distribution": f"""SELECT lang AS label, count(*) AS count,
          {pct('count(*)', '(SELECT count(*) FROM documents)', 1)} AS pct FROM documents GROUP BY 1""",
        "U1_label_union": f"WITH {PRED} SELECT auto_label AS label FROM pred UNION SELECT source FROM pred",
        "U2_missing_columns": f"""SELECT name AS "column", (SELECT count(*) FROM documents) AS n_rows FROM
          (SELECT unnest([{', '.join(q(c) for c in REQUIRED_COLUMNS)}]) AS name)
          WHERE name NOT IN (SELECT column_name FROM (DESCRIBE documents))""",
        "X1_krippendorff_alpha": f"""WITH {PRED}, {GOLD}, v AS (SELECT _id AS item, auto_label AS label FROM pred
            UNION ALL SELECT _id, lang FROM pred UNION ALL SELECT source_id, final_label FROM gold),
          m AS (SELECT item, count(*) AS m FROM v GROUP BY 1 HAVING count(*) > 1),
          u AS (SELECT item, label, m, count(*) AS n FROM v JOIN m USING (item) GROUP BY ALL),
          c AS (SELECT label, CAST(sum(n) AS DOUBLE) AS n FROM u GROUP BY 1),
          o AS (SELECT sum(CAST(n AS DOUBLE) * (m - n) / (m - 1)) AS d FROM u)
          SELECT (SELECT count(*) FROM m) AS n_items, CAST(sum(n) AS BIGINT) AS n_values,
            {r('1 - (sum(n) - 1) * (SELECT d FROM o) / (sum(n) * sum(n) - sum(n * n))', 4)} AS alpha FROM c""",
        "X2_label_drift": f"""WITH d AS (SELECT strftime(ts, '%Y-%m-%d') AS batch, event_type AS label FROM events),
          p AS (SELECT label, CAST(count(*) AS HUGEINT) AS n, (SELECT count(*) FROM d) AS total FROM d GROUP BY 1),
          b AS (SELECT batch, CAST(count(*) AS HUGEINT) AS n FROM d GROUP BY 1),
          s AS (SELECT batch, label, CAST(count(*) AS HUGEINT) AS n FROM d GROUP BY ALL)
          SELECT b.batch, CAST(any_value(b.n) AS BIGINT) AS n,
            {r('CAST(sum(abs(coalesce(s.n, 0) * p.total - p.n * b.n)) AS DOUBLE) / CAST(any_value(2 * b.n * p.total) AS DOUBLE)', 4)}
              AS drift
          FROM b CROSS JOIN p LEFT JOIN s ON s.batch = b.batch AND s.label = p.label GROUP BY b.batch""",
        "X3_near_duplicates": f"WITH {_near_ctes()} SELECT * FROM near",
        "X3_near_duplicate_pairs": f"""WITH {_near_ctes()} SELECT least(x.class_id, y.class_id) AS id_a,
            greatest(x.class_id, y.class_id) AS id_b, overlap, union_size
          FROM pairs JOIN c x ON x.norm = a JOIN c y ON y.norm = b""",
        "X3_check_near_duplicates": f"""WITH {_near_ctes()} SELECT 'Near Duplicates' AS "check", d AS near_duplicates,
            {pct('d', 'n')} AS near_duplicate_pct, s AS different_but_similar, d = 0 AS passed,
            CASE WHEN d > 0 THEN {commas('d')} || ' texts with copies or near copies' ELSE '' END AS issues
          FROM (SELECT count(*) AS n, count(*) FILTER (WHERE n_near > 0 OR copies > 1) AS d,
            count(*) FILTER (WHERE n_near > 0) AS s FROM near)""",
        "X4_boilerplate_lines": f"WITH {_line_ctes()} SELECT *, {pct('n_flagged', 'n_lines')} AS flagged_pct FROM shares",
        "X4_boilerplate_runs": f"WITH {_line_ctes()} SELECT * FROM runs",
        "X4_check_boilerplate": f"""WITH {_line_ctes()} SELECT 'Boilerplate' AS "check", n_texts, n_lines, flagged_lines,
            {pct('flagged_lines', 'n_lines')} AS flagged_lines_pct, with_boilerplate, mostly_boilerplate, longest_run,
            mostly_boilerplate = 0 AS passed, concat_ws('; ',
              CASE WHEN mostly_boilerplate > 0 THEN {commas('mostly_boilerplate')} || ' texts at least 50% boilerplate' END,
              CASE WHEN with_boilerplate > 0 THEN {commas('with_boilerplate')} || ' texts with lines that many texts share' END)
              AS issues
          FROM (SELECT count(*) AS n_texts, CAST(sum(n_lines) AS BIGINT) AS n_lines, CAST(sum(n_flagged) AS BIGINT) AS flagged_lines,
            count(*) FILTER (WHERE n_flagged > 0) AS with_boilerplate, max(longest_run) AS longest_run,
            count(*) FILTER (WHERE {pct('n_flagged', 'n_lines')} >= 50) AS mostly_boilerplate FROM shares)""",
        "X5_review_tiers": """SELECT CASE WHEN c = 0 THEN '0%' WHEN c < 0.2 THEN '1–20%' WHEN c < 0.5 THEN '20–50%'
            WHEN c < 0.8 THEN '50–80%' ELSE '80–100%' END AS tier,
          CASE WHEN c = 0 THEN 'always review' WHEN c < 0.2 THEN 'review recommended' WHEN c < 0.5 THEN 'review if time allows'
            WHEN c < 0.8 THEN 'accept or spot-check' ELSE 'accept' END AS action, count(*) AS n
          FROM (SELECT CASE WHEN event_type = 'view' THEN 0 ELSE least(value / 50.0, 1.0) END AS c FROM events) GROUP BY ALL""",
        "X6_annotator_scorecard": f"""WITH {REC}, {GOLD}, done AS (SELECT * FROM rec WHERE is_human_reviewed),
          pace AS (SELECT annotator, count(*) AS n_done, sum(annotation_time_sec) AS seconds FROM done GROUP BY 1),
          assigned AS (SELECT annotator, count(*) AS n_assigned FROM dec GROUP BY 1),
          nth AS (SELECT annotator, d.final_label = g.final_label AS hit,
              row_number() OVER (PARTITION BY annotator ORDER BY CAST(source_id AS BIGINT)) AS i
            FROM done d JOIN gold g USING (source_id)),
          cal AS (SELECT annotator, count(*) AS n_calibration, count(*) FILTER (WHERE hit) AS n_matching FROM nth
            WHERE i <= 10 GROUP BY 1)
          SELECT annotator, 'language' AS task, n_done, n_assigned, {r('n_done * 3600 / seconds', 1)} AS items_per_hour,
            {pct('n_done', 'n_assigned')} AS completion_pct, {pct('n_done', 'n_assigned')} >= 95 AS completion_ok,
            coalesce(n_calibration, 0) AS n_calibration,
            CASE WHEN n_calibration IS NOT NULL THEN {pct('n_matching', 'n_calibration')} END AS calibration_pct,
            CASE WHEN n_calibration IS NOT NULL THEN {pct('n_matching', 'n_calibration')} >= 80 END AS calibration_ok
          FROM pace JOIN assigned USING (annotator) LEFT JOIN cal USING (annotator)""",
        "X7_import_label_studio": f"""WITH {REC} SELECT source_id, auto_label, auto_confidence, final_label,
          final_label <> auto_label AS human_override, md5(text) AS text_md5 FROM rec""",
        "X8_stream_label": f"WITH {PRED} SELECT doc_id, auto_label, auto_confidence FROM pred",
        "X8_windowed_counts": """SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, event_type AS label, count(*) AS n
          FROM (SELECT date_trunc('hour', ts) AS w, event_type FROM events) GROUP BY ALL""",
    }
    return {name: _flat_text(text) for name, text in queries.items()}
