"""SQL counterparts of the registered queries, written independently for DuckDB."""

from __future__ import annotations

# Stop words, contractions and punctuation, as in the normalizer.
STOP = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "he", "in", "is", "it",
    "its", "of", "on", "that", "the", "to", "was", "were", "will", "with",
)
CONTRACTIONS = [
    ("can't", "can not"), ("cannot", "can not"), ("won't", "will not"), ("n't", " not"),
    ("'re", " are"), ("'s", " is"), ("'d", " would"), ("'ll", " will"), ("'t", " not"),
    ("'ve", " have"), ("'m", " am"),
]
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
VISIBLE = (
    r"[^\s\x1c-\x1f\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}"
    r"\x{205f}\x{3000}]+"
)
LINK = rf"https?://{VISIBLE}|www\.{VISIBLE}"
WORD = r"[\p{L}\p{N}_]+"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sub(text: str, pattern: str, new: str) -> str:
    return f"regexp_replace({text}, {lit(pattern)}, {lit(new)}, 'g')"


def unescaped(text: str) -> str:
    """The four entities that occur in the tables, the ampersand last."""
    for name, char in (("middot", "·"), ("copy", "©"), ("quot", '"'), ("amp", "&")):
        text = f"replace({text}, '&{name};', {lit(char)})"
    return text


def contracted(text: str) -> str:
    for short, long in CONTRACTIONS:
        text = f"replace({text}, {lit(short)}, {lit(long)})"
    return text


def squeezed(text: str) -> str:
    return (
        f"array_to_string(list_filter(string_split({text}, ''), lambda x, i: NOT (i > 2 AND "
        f"x <> chr(10) AND x = string_split({text}, '')[i-1] AND "
        f"x = string_split({text}, '')[i-2])), '')"
    )


def blanked(text: str) -> str:
    return f"translate({text}, {lit(PUNCTUATION)}, {lit(' ' * len(PUNCTUATION))})"


def mentions(text: str) -> str:
    return sub(text, f"@{WORD}", " <user> ")


def hashtags(text: str) -> str:
    return sub(text, f"#({WORD})", r" \1 ")


def numbered(text: str) -> str:
    return sub(text, r"\p{Nd}+", " <num> ")


def normalized(
    source: str, mode: str = "standard", lower: bool = True, stop=tuple(STOP), least: int = 2
) -> str:
    """CTEs ``docs`` .. ``clean(doc_id, tokens, clean)`` over a ``SELECT doc_id, text``."""
    first = unescaped("coalesce(text, '')")
    first = contracted(f"lower({first})" if lower else first)
    if mode == "tweet":
        second = hashtags(mentions(sub("t", LINK, " <url> ")))
        # The list form of the squeeze needs a column, not a long expression.
        third = (
            "array_to_string(list_filter(a, lambda x, i: NOT (i > 2 AND x <> chr(10) "
            "AND x = a[i-1] AND x = a[i-2])), '')"
        )
    else:
        second, third = sub("t", LINK, " "), "t"
    final = "t" if mode == "minimal" else numbered(blanked("t"))
    words = ", ".join(lit(w) for w in stop) or "''"
    return f"""docs AS ({source}),
n1 AS (SELECT doc_id, {first} AS t FROM docs),
n2 AS (SELECT doc_id, {second} AS t FROM n1),
n3 AS (SELECT doc_id, t, {"string_split(t, '')" if mode == "tweet" else "NULL"} AS a FROM n2),
n4 AS (SELECT doc_id, {third} AS t FROM n3),
n5 AS (SELECT doc_id, {final} AS t FROM n4),
n6 AS (SELECT doc_id, list_transform(regexp_extract_all(t, '[a-zA-Z_<>'']+'),
  lambda x: trim(x, '''_')) AS raw FROM n5),
n7 AS (SELECT doc_id, list_filter(raw, lambda x: length(x) >= {max(least, 1)}
  AND x NOT IN ({words})) AS tokens FROM n6),
clean AS (SELECT doc_id, tokens, coalesce(array_to_string(tokens, ' '), '') AS clean FROM n7)"""


DOCUMENTS = "SELECT doc_id, text FROM documents"
PAGES = "SELECT page_id AS doc_id, url || ' ' || html AS text FROM pages"
MENTIONED = (
    "SELECT page_id AS doc_id, replace(replace(url || ' ' || html, ' d', ' @d'), ' a', ' #a') "
    "AS text FROM pages"
)
APOSTROPHES = (
    "SELECT doc_id, replace(regexp_replace(lower(text), ' ([stdm]|re|ll|ve)', '''\\1', 'g'), "
    "'nt', 'n''t') AS text FROM documents"
)
REVIEWS = """reviews AS (SELECT d.doc_id AS "Id", 1 + 2 * l.quality + 2 * (1 - l.toxic) AS "Score",
  CASE WHEN lang <> 'de' THEN lang END AS "Summary", text AS "Text"
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""
SPACE = (
    r"[\s\x1c-\x1f\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}"
    r"\x{205f}\x{3000}]+"
)
JOINED = sub(
    """coalesce("Summary", '') || ' ' || coalesce("Text", '')""",
    rf"\A{SPACE}|{SPACE}\z", "",
)
CORPUS = f"""{REVIEWS},
corpus AS (SELECT 'amazon' AS dataset, "Id" AS doc_id, {JOINED} AS text,
  CASE WHEN "Score" >= 4 THEN 1 ELSE 0 END AS label, "Score" AS raw_score
  FROM reviews WHERE "Score" IS DISTINCT FROM 3)"""
MESSAGES = """messages AS (SELECT CASE role WHEN 'user' THEN 4 WHEN 'assistant' THEN 0 ELSE 2 END
  AS target, conv_id * 1000 + turn AS tweet_id, text FROM conversations),
corpus AS (SELECT 'sentiment140' AS dataset, tweet_id AS doc_id, text,
  CASE WHEN target = 4 THEN 1 ELSE 0 END AS label, target AS raw_score
  FROM messages WHERE target IN (0, 4))"""


def marked(expression: str, source: str) -> str:
    return f"WITH docs AS ({source}) SELECT doc_id, {expression} AS marked FROM docs"


def clean_text(source: str, **settings) -> str:
    return f"WITH {normalized(source, **settings)} SELECT doc_id, clean FROM clean"


def counted(source: str = DOCUMENTS, bigrams: bool = True) -> str:
    """CTEs up to ``counts(doc_id, term, tf)`` and ``stats(term, df, cf)``."""
    pairs = """ UNION ALL SELECT doc_id, term || ' ' || nxt FROM (SELECT doc_id, term,
  lead(term) OVER (PARTITION BY doc_id ORDER BY pos) AS nxt FROM words) WHERE nxt IS NOT NULL"""
    return f"""{normalized(source)},
word_lists AS (SELECT doc_id, list_filter(regexp_extract_all(lower(clean), '[\\p{{L}}\\p{{N}}_]+'),
  lambda x: length(x) >= 2) AS w FROM clean),
words AS (SELECT doc_id, unnest(w) AS term, generate_subscripts(w, 1) AS pos FROM word_lists),
grams AS (SELECT doc_id, term FROM words{pairs if bigrams else ""}),
counts AS (SELECT doc_id, term, count(*) AS tf FROM grams GROUP BY doc_id, term),
stats AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM counts GROUP BY term)"""


def fitted(source: str = DOCUMENTS, bigrams: bool = True, limit: int | None = 100_000,
           least: str = "2") -> str:
    """CTEs up to ``vocab(term, term_id, df, cf)`` and ``totals(n_docs, avgdl)``."""
    cut = f"ORDER BY cf DESC, term LIMIT {limit}" if limit else ""
    return f"""{counted(source, bigrams)},
kept AS (SELECT * FROM stats WHERE df >= {least} {cut}),
vocab AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS term_id, df, cf
  FROM kept),
totals AS (SELECT n_docs, (SELECT coalesce(sum(cf), 0) FROM vocab) / n_docs::DOUBLE AS avgdl
  FROM (SELECT count(*) AS n_docs FROM docs))"""


IDF = "ln((n_docs - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE) + 1.0::DOUBLE)"


def bm25_of(counts: str, name: str) -> str:
    """CTEs weighting ``counts`` by the fitted vocabulary and totals."""
    return f"""{name}_known AS (SELECT c.*, v.term_id, {IDF} AS idf, avgdl,
  sum(c.tf) OVER (PARTITION BY c.doc_id) AS dl
  FROM {counts} c JOIN vocab v ON c.term = v.term, totals),
{name} AS (SELECT *, idf * tf * 2.5::DOUBLE /
  (tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / greatest(avgdl, 1e-12))) AS weight
  FROM {name}_known)"""


def searched(requests: str, most: int = 50) -> str:
    """CTEs up to ``hits`` over a request table ``(query_id, query, sentiment, top_k)``."""
    query_words = normalized("SELECT query_id AS doc_id, query AS text FROM asked")
    for name in ("docs", "n1", "n2", "n3", "n4", "n5", "n6", "n7", "clean"):
        for end in (" AS (", " WHERE", ")", "\n"):
            query_words = query_words.replace(f"FROM {name}{end}", f"FROM q_{name}{end}")
        query_words = query_words.replace(f"{name} AS (SELECT", f"q_{name} AS (SELECT")
    return f"""{CORPUS},
{fitted("SELECT doc_id, text FROM corpus", limit=150_000)},
{bm25_of("counts", "postings")},
requests AS ({requests}),
asked AS (SELECT * FROM requests WHERE length(query) >= 1
  AND (sentiment IS NULL OR sentiment IN ('positive', 'negative'))
  AND top_k BETWEEN 1 AND {most}),
{query_words},
q_lists AS (SELECT doc_id, list_filter(regexp_extract_all(lower(clean), '[\\p{{L}}\\p{{N}}_]+'),
  lambda x: length(x) >= 2) AS w FROM q_clean),
q_words AS (SELECT doc_id, unnest(w) AS term, generate_subscripts(w, 1) AS pos FROM q_lists),
q_grams AS (SELECT doc_id, term FROM q_words UNION ALL SELECT doc_id, term || ' ' || nxt FROM
  (SELECT doc_id, term, lead(term) OVER (PARTITION BY doc_id ORDER BY pos) AS nxt FROM q_words)
  WHERE nxt IS NOT NULL),
q_counts AS (SELECT doc_id, term, count(*) AS tf FROM q_grams GROUP BY doc_id, term),
{bm25_of("q_counts", "q_weights")},
scores AS (SELECT a.query_id, a.top_k, p.doc_id, sum(p.weight * q.weight) AS score
  FROM postings p JOIN q_weights q ON p.term = q.term JOIN asked a ON q.doc_id = a.query_id
  JOIN corpus d ON p.doc_id = d.doc_id
  WHERE a.sentiment IS NULL OR d.label = CASE a.sentiment WHEN 'positive' THEN 1 ELSE 0 END
  GROUP BY a.query_id, a.top_k, p.doc_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id)
  AS INTEGER) AS rank FROM scores WHERE score > 0),
hits AS (SELECT r.query_id, r.rank, CAST(r.doc_id AS VARCHAR) AS doc_id, round(r.score, 6) AS score,
  CASE WHEN d.label = 1 THEN 'positive' ELSE 'negative' END AS sentiment,
  substr(d.text, 1, 500) AS text
  FROM ranked r JOIN corpus d ON r.doc_id = d.doc_id WHERE r.rank <= r.top_k)"""


REQUESTS = """SELECT item_id AS query_id,
  CASE WHEN item_id % 11 = 10 THEN '' ELSE text END AS query,
  CASE item_id % 5 WHEN 1 THEN 'positive' WHEN 2 THEN 'negative' WHEN 3 THEN 'neutral' END
  AS sentiment, CAST(item_id % 53 AS INTEGER) AS top_k FROM benchmark"""


def frequent(sentiment: str, top_k: int = 10) -> str:
    return f"""SELECT CAST(0 AS BIGINT) AS query_id,
  string_agg(term, ' ' ORDER BY cf DESC, term) AS query,
  {sentiment} AS sentiment, {top_k} AS top_k FROM (SELECT term, sum(tf) AS cf FROM counts
  WHERE term NOT LIKE '% %' GROUP BY term ORDER BY cf DESC, term LIMIT 5)"""


PAIRS = f"""{fitted(bigrams=False, limit=20_000)},
seq AS (SELECT doc_id, unnest(tokens) AS term, generate_subscripts(tokens, 1) AS pos FROM clean),
known AS (SELECT s.doc_id, s.term, row_number() OVER (PARTITION BY s.doc_id ORDER BY s.pos) AS pos
  FROM seq s JOIN vocab v ON s.term = v.term),
near AS ({" UNION ALL ".join(
    f"SELECT a.term AS one, b.term AS other, {12 // k} AS parts FROM known a JOIN known b "
    f"ON a.doc_id = b.doc_id AND b.pos = a.pos + {k}" for k in (1, 2, 3, 4))}),
cells AS (SELECT row_term, col_term, sum(parts) / 12.0::DOUBLE AS x FROM (
  SELECT one AS row_term, other AS col_term, parts FROM near
  UNION ALL SELECT other, one, parts FROM near) GROUP BY row_term, col_term)"""

# Every document twice under one id: once as it is, once behind two more words.
TWICE = """SELECT doc_id * 2 AS doc_id, text FROM documents
  UNION ALL SELECT doc_id * 2 + 1, 'copied words ' || text FROM documents"""
# A classifier whose coefficients follow from the term numbers.
GIVEN = """raw AS (SELECT doc_id, term_id,
  tf * (ln((1.0::DOUBLE + n_docs) / (1.0::DOUBLE + df)) + 1.0::DOUBLE) AS x
  FROM counts c JOIN vocab v ON c.term = v.term, totals),
scored AS (SELECT doc_id, x / sqrt(sum(x * x) OVER (PARTITION BY doc_id))
  * (term_id % 7 - 3) / 2.0::DOUBLE AS part FROM raw),
margins AS (SELECT d.doc_id, 0.05::DOUBLE + coalesce(sum(part), 0) AS margin
  FROM docs d LEFT JOIN scored s ON d.doc_id = s.doc_id GROUP BY d.doc_id),
given AS (SELECT doc_id, CASE WHEN margin > 0 THEN 1 ELSE 0 END AS prediction,
  CASE WHEN margin > 0 THEN 'positive' ELSE 'negative' END AS sentiment,
  round(1.0::DOUBLE / (1.0::DOUBLE + exp(-abs(margin))), 6) AS probability FROM margins)"""

JUDGED = "judged AS (SELECT doc_id, quality AS label, 1 - toxic AS prediction FROM labels)"
UNIT = """vecs AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
unit AS (SELECT vec_id, list_transform(e, lambda x: CASE WHEN n > 0 THEN x / n ELSE x END) AS e
  FROM (SELECT *, sqrt(list_inner_product(e, e)) AS n FROM vecs))"""


# The training rows of the split, and their vocabulary.
TRAINED = f"""{REVIEWS}, marked AS (SELECT doc_id, text, quality AS label FROM documents
JOIN labels USING (doc_id)), flagged AS (SELECT doc_id, text, r <= round(0.2::DOUBLE * n) AS test
  FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(concat(doc_id, '-42'))) AS r,
    count(*) OVER (PARTITION BY label) AS n FROM marked)),
{fitted("SELECT doc_id, text FROM flagged WHERE NOT test")}"""
FLAT = """SELECT doc_id, regexp_replace(coalesce(text, 'nan'), '[^\\x00-\\xFF]|[\\r\\n]', ' ', 'g') AS text
  FROM corpus"""


def binary(where: str, by: str = "") -> str:
    """Metrics of class 1 over a table with ``label`` and ``prediction``."""
    first, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return f"""SELECT {first}avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS accuracy,
  coalesce(tp / nullif(said, 0)::DOUBLE, 0) AS precision,
  coalesce(tp / nullif(real, 0)::DOUBLE, 0) AS recall,
  coalesce(2 * tp / nullif(said + real, 0)::DOUBLE, 0) AS f1, count(*) AS rows
  FROM (SELECT *, count(*) FILTER (label = 1 AND prediction = 1) OVER ({'PARTITION BY ' + by if by
  else ''}) AS tp, count(*) FILTER (prediction = 1) OVER ({'PARTITION BY ' + by if by else ''})
  AS said, count(*) FILTER (label = 1) OVER ({'PARTITION BY ' + by if by else ''}) AS real
  FROM {where}) GROUP BY {first}tp, said, real"""


# The suffix rules and irregular words of the stemmer; SQL over the distinct tokens.

STEP_2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("fulli", "ful"),
]
STEP_3 = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""),
    ("ness", ""),
]
STEP_4 = (
    "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"
).split()
IRREGULAR = {
    "skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed",
    "exceed": "exceed", "succeed": "succeed",
}


def shape(w: str) -> str:
    return (
        f"list_reduce(list_prepend('', string_split({w}, '')), lambda s, c: s || CASE WHEN c IN "
        f"('a','e','i','o','u') OR (c = 'y' AND s LIKE '%c') THEN 'v' WHEN c = '' THEN '' "
        f"ELSE 'c' END)"
    )


def measure(w: str) -> str:
    s = shape(w)
    return f"((length({s}) - length(replace({s}, 'vc', ''))) // 2)"


def short(w: str) -> str:
    s = shape(w)
    return f"({s} = 'vc' OR ({s} LIKE '%cvc' AND right({w}, 1) NOT IN ('w', 'x', 'y')))"


def but(w: str, n: int) -> str:
    return f"substr({w}, 1, length({w}) - {n})"


def suffixes(w: str, rules, least: int) -> str:
    parts = [
        f"WHEN {w} LIKE '%{old}' THEN CASE WHEN {measure(but(w, len(old)))} >= {least} "
        f"THEN {but(w, len(old))} || '{new}' ELSE {w} END"
        for old, new in rules
    ]
    return f"CASE {' '.join(parts)} ELSE {w} END"


def stemmed() -> str:
    keep = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in IRREGULAR.items())
    fours = " ".join(
        f"WHEN w LIKE '%{s}' THEN CASE WHEN {measure(but('w', len(s)))} >= 2"
        + (f" AND right({but('w', 3)}, 1) IN ('s', 't')" if s == "ion" else "")
        + f" THEN {but('w', len(s))} ELSE w END"
        for s in STEP_4
    )
    return f"""{normalized(DOCUMENTS)},
seq AS (SELECT doc_id, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos FROM clean),
s0 AS (SELECT DISTINCT token, token AS w FROM seq),
s1 AS (SELECT token, CASE WHEN w LIKE '%ies' THEN CASE WHEN length(w) = 4 THEN {but("w", 1)}
  ELSE {but("w", 2)} END WHEN w LIKE '%sses' THEN {but("w", 2)} WHEN w LIKE '%ss' THEN w
  WHEN w LIKE '%s' THEN {but("w", 1)} ELSE w END AS w FROM s0),
s2 AS (SELECT token, w, CASE WHEN w LIKE '%ied' OR w LIKE '%eed' THEN NULL
  WHEN w LIKE '%ed' THEN CASE WHEN {shape(but("w", 2))} LIKE '%v%' THEN {but("w", 2)} END
  WHEN w LIKE '%ing' AND {shape(but("w", 3))} LIKE '%v%' THEN {but("w", 3)} END AS b FROM s1),
s3 AS (SELECT token, CASE
  WHEN w LIKE '%ied' THEN CASE WHEN length(w) = 4 THEN {but("w", 1)} ELSE {but("w", 2)} END
  WHEN w LIKE '%eed' THEN CASE WHEN {measure(but("w", 3))} > 0 THEN {but("w", 1)} ELSE w END
  WHEN b IS NULL THEN w
  WHEN b LIKE '%at' OR b LIKE '%bl' OR b LIKE '%iz' THEN b || 'e'
  WHEN length(b) > 1 AND right(b, 1) = right({but("b", 1)}, 1) AND {shape("b")} LIKE '%c'
    THEN CASE WHEN right(b, 1) IN ('l', 's', 'z') THEN b ELSE {but("b", 1)} END
  WHEN {measure("b")} = 1 AND {short("b")} THEN b || 'e' ELSE b END AS w FROM s2),
s4 AS (SELECT token, CASE WHEN w LIKE '%y' AND length(w) > 2 AND {shape(but("w", 1))} LIKE '%c'
  THEN {but("w", 1)} || 'i' ELSE w END AS w FROM s3),
s5 AS (SELECT token, CASE WHEN w LIKE '%alli' AND {measure(but("w", 4))} > 0
  THEN {but("w", 2)} ELSE w END AS w FROM s4),
s6 AS (SELECT token, CASE WHEN w LIKE '%logi' THEN CASE WHEN {measure(but("w", 3))} > 0
  THEN {but("w", 1)} ELSE w END ELSE {suffixes("w", STEP_2, 1)} END AS w FROM s5),
s7 AS (SELECT token, {suffixes("w", STEP_3, 1)} AS w FROM s6),
s8 AS (SELECT token, CASE {fours} ELSE w END AS w FROM s7),
s9 AS (SELECT token, CASE WHEN w LIKE '%e' AND ({measure(but("w", 1))} > 1
  OR ({measure(but("w", 1))} = 1 AND NOT {short(but("w", 1))})) THEN {but("w", 1)} ELSE w END
  AS w FROM s8),
s10 AS (SELECT token, CASE WHEN w LIKE '%ll' AND {measure(but("w", 1))} > 1 THEN {but("w", 1)}
  ELSE w END AS w FROM s9),
stems AS (SELECT token, CASE token {keep} ELSE CASE WHEN length(token) <= 2 THEN token ELSE w END
  END AS stem FROM s10),
joined AS (SELECT s.doc_id, string_agg(t.stem, ' ' ORDER BY s.pos) AS clean
  FROM seq s JOIN stems t ON s.token = t.token GROUP BY s.doc_id)"""


ORACLES: dict[str, str] = {
    "label_threshold": f"WITH {CORPUS} SELECT dataset, doc_id, label, raw_score FROM corpus",
    "neutral_filter": f"""WITH {REVIEWS} SELECT "Id", "Score" FROM reviews
WHERE "Score" <> 3 OR "Score" IS NULL""",
    "label_equality": f"WITH {MESSAGES} SELECT dataset, doc_id, label, raw_score FROM corpus",
    "text_concat": f"WITH {CORPUS} SELECT doc_id, text FROM corpus",
    "snippet": f"""WITH {CORPUS} SELECT doc_id, 'positive' AS sentiment,
substr(text, 1, 500) AS snippet FROM corpus WHERE label = 1""",
    "head_sample": f"""WITH {CORPUS},
firsts AS (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 450)
SELECT doc_id, label, raw_score FROM corpus SEMI JOIN firsts USING (doc_id)
ORDER BY md5(concat(doc_id, '-42')) LIMIT 150""",
    "sample_md5": f"""WITH {CORPUS} SELECT doc_id, label FROM corpus
ORDER BY md5(concat(doc_id, '-42')) LIMIT 300""",
    "class_half_sample": f"""WITH {MESSAGES} SELECT doc_id, label FROM (SELECT *, row_number()
OVER (PARTITION BY label ORDER BY doc_id) AS r FROM corpus)
WHERE r <= CASE label WHEN 0 THEN 50 ELSE 51 END""",
    "stratified_split": f"""WITH {CORPUS} SELECT doc_id, label,
CASE WHEN r <= round(0.2::DOUBLE * n) THEN 1 ELSE 0 END AS is_test FROM (SELECT *, row_number()
OVER (PARTITION BY label ORDER BY md5(concat(doc_id, '-42'))) AS r,
count(*) OVER (PARTITION BY label) AS n FROM corpus)""",
    "norm_minimal": clean_text(DOCUMENTS, mode="minimal"),
    "norm_standard": clean_text(DOCUMENTS),
    "norm_tweet": f"""WITH {MESSAGES}, {normalized(
        "SELECT tweet_id AS doc_id, text FROM messages", mode="tweet")}
SELECT doc_id, clean FROM clean""",
    "norm_pages": clean_text(PAGES),
    "norm_pages_minimal": clean_text(PAGES, mode="minimal"),
    "norm_pages_tweet": clean_text(MENTIONED, mode="tweet"),
    "norm_contractions": clean_text(APOSTROPHES),
    "norm_contractions_minimal": clean_text(APOSTROPHES, mode="minimal"),
    "stopwords_extra": clean_text(
        DOCUMENTS, stop=(*STOP, "no", "nor", "not", "que", "der", "los", "tion"), least=3
    ),
    "norm_case_kept": clean_text(DOCUMENTS, lower=False, stop=(), least=1),
    "html_unescape_basic": marked(unescaped("text"), PAGES),
    "contractions": marked(contracted("text"), APOSTROPHES),
    "link_removal": marked(sub("text", LINK, " "), PAGES),
    "link_tags": marked(sub("text", LINK, " <url> "), PAGES),
    "mention_tags": marked(mentions("text"), MENTIONED),
    "hashtag_words": marked(hashtags("text"), MENTIONED),
    "elongation_squeeze": f"""WITH docs AS (SELECT doc_id, string_split(text, '') AS a FROM ({PAGES}))
SELECT doc_id, array_to_string(list_filter(a, lambda x, i: NOT (i > 2 AND x <> chr(10)
AND x = a[i-1] AND x = a[i-2])), '') AS marked FROM docs""",
    "punctuation_blanks": marked(blanked("text"), PAGES),
    "number_tags": marked(numbered("text"), PAGES),
    "lemma_lookup": f"""WITH {counted(bigrams=False)},
lookup AS (SELECT DISTINCT term AS surface, substr(term, 1, length(term) - 1) AS lemma
  FROM words WHERE term LIKE '%s'),
seq AS (SELECT doc_id, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos FROM clean),
joined AS (SELECT s.doc_id, string_agg(coalesce(l.lemma, s.token), ' ' ORDER BY s.pos) AS clean
  FROM seq s LEFT JOIN lookup l ON s.token = l.surface GROUP BY s.doc_id)
SELECT d.doc_id, coalesce(j.clean, '') AS clean FROM docs d LEFT JOIN joined j USING (doc_id)""",
    "stem": f"""WITH {stemmed()}
SELECT d.doc_id, coalesce(j.clean, '') AS clean FROM docs d LEFT JOIN joined j USING (doc_id)""",
    "ngrams": f"""WITH {counted()} SELECT doc_id, term, tf FROM counts WHERE term LIKE '% %'""",
    "doc_freq": f"WITH {counted()} SELECT term, df, cf FROM stats",
    "vocab_topk": f"WITH {fitted(limit=5000)} SELECT term, term_id, df, cf FROM vocab",
    "vocab_share": f"""WITH {fitted(limit=None,
        least="0.01::DOUBLE * (SELECT count(*) FROM docs)")}
SELECT term, term_id, df, cf FROM vocab""",
    "bow": f"""WITH {fitted()} SELECT doc_id, c.term, term_id, CAST(tf AS DOUBLE) AS weight
FROM counts c JOIN vocab v ON c.term = v.term""",
    "tfidf": f"""WITH {fitted()},
raw AS (SELECT doc_id, c.term, term_id,
  tf * (ln((1.0::DOUBLE + n_docs) / (1.0::DOUBLE + df)) + 1.0::DOUBLE) AS x
  FROM counts c JOIN vocab v ON c.term = v.term, totals)
SELECT doc_id, term, term_id, round(x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)), 6) AS weight
FROM raw""",
    "bm25_stats": f"""WITH {fitted()} SELECT n_docs, (SELECT count(*) FROM vocab) AS vocabulary_size,
round(avgdl, 6) AS avgdl FROM totals""",
    "bm25_idf": f"WITH {fitted()} SELECT term, df, round({IDF}, 6) AS idf FROM vocab, totals",
    "doc_lengths": f"""WITH {fitted()} SELECT d.doc_id, CAST(coalesce(sum(k.tf), 0) AS BIGINT)
AS doc_len FROM docs d LEFT JOIN (SELECT doc_id, tf FROM counts c JOIN vocab v ON c.term = v.term) k
ON d.doc_id = k.doc_id GROUP BY d.doc_id""",
    "bm25_weights": f"""WITH {fitted()}, {bm25_of("counts", "weighted")}
SELECT doc_id, term, term_id, tf, round(weight, 6) AS weight FROM weighted""",
    "cooccurrence": f"WITH {PAIRS} SELECT row_term, col_term, round(x, 6) AS x FROM cells",
    "ppmi": f"""WITH {PAIRS},
row_sums AS (SELECT row_term, sum(x) AS r FROM cells GROUP BY row_term),
col_sums AS (SELECT col_term, sum(x) AS c FROM cells GROUP BY col_term),
scored AS (SELECT row_term, col_term,
  ln(x * (SELECT sum(x) FROM cells) / greatest(r * c, 1e-12)) AS x
  FROM cells JOIN row_sums USING (row_term) JOIN col_sums USING (col_term))
SELECT row_term, col_term, round(x, 6) AS x FROM scored WHERE x > 0""",
    "unit_vectors": f"""WITH {UNIT} SELECT vec_id, CAST(dim - 1 AS INTEGER) AS dim, round(x, 6) AS x
FROM (SELECT vec_id, unnest(e) AS x, generate_subscripts(e, 1) AS dim FROM unit)""",
    "nearest_vectors": f"""WITH {UNIT},
pairs AS (SELECT q.vec_id, v.vec_id AS neighbor, list_inner_product(q.e, v.e) AS s
  FROM unit q JOIN unit v ON v.vec_id <> q.vec_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY round(s, 12) DESC, neighbor)
  AS INTEGER) AS rank FROM pairs)
SELECT vec_id, neighbor, rank, round(s, 6) AS cosine_similarity FROM ranked WHERE rank <= 10""",
    "top_norm": f"""WITH {UNIT} SELECT vec_id, round(sqrt(list_inner_product(e, e)), 6) AS norm
FROM vecs ORDER BY sqrt(list_inner_product(e, e)) DESC, vec_id LIMIT 150""",
    "mean_embedding": f"""WITH {fitted(bigrams=False, limit=20_000)}, {UNIT},
seq AS (SELECT doc_id, unnest(tokens) AS term FROM clean),
long AS (SELECT v.term, unnest(e) AS x, generate_subscripts(e, 1) AS dim
  FROM vocab v JOIN vecs ON v.term_id % (SELECT count(*) FROM vecs) = vecs.vec_id),
means AS (SELECT doc_id, dim, avg(x) AS x FROM seq JOIN long USING (term) GROUP BY doc_id, dim)
SELECT d.doc_id, CAST(g.dim - 1 AS INTEGER) AS dim, round(coalesce(m.x, 0), 6) AS x
FROM docs d CROSS JOIN (SELECT unnest(range(1, 65)) AS dim) g
LEFT JOIN means m ON m.doc_id = d.doc_id AND m.dim = g.dim""",
    "repeated_ids": f"""WITH {fitted(TWICE)} SELECT doc_id // 2 AS doc_id, c.term, term_id,
CAST(tf AS DOUBLE) AS weight FROM counts c JOIN vocab v ON c.term = v.term""",
    "repeated_ids_split": """WITH twice AS (SELECT quality AS label FROM documents JOIN labels
USING (doc_id) UNION ALL SELECT 1 - quality FROM documents JOIN labels USING (doc_id)),
sizes AS (SELECT label, count(*) AS n, CAST(floor(0.2::DOUBLE * count(*) + 0.5) AS BIGINT) AS t
  FROM twice GROUP BY label)
SELECT label, 1 AS is_test, t AS n FROM sizes UNION ALL SELECT label, 0, n - t FROM sizes""",
    "svd_gram": """WITH vecs AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
asked AS (SELECT vec_id, e FROM vecs JOIN benchmark ON vec_id = item_id)
SELECT a.vec_id, b.vec_id AS other, round(list_inner_product(a.e, b.e), 6) AS product
FROM asked a CROSS JOIN asked b""",
    "wide_sink": """SELECT CAST(vec_id AS VARCHAR) AS term, """ + ", ".join(
        f"CAST(embedding[{i + 1}] AS DOUBLE) AS dim_{i}" for i in range(64)
    ) + " FROM embeddings",
    "reviews_csv": f"WITH {CORPUS} SELECT doc_id, text FROM corpus",
    "messages_csv": f"WITH {MESSAGES} SELECT dataset, doc_id, text, label, raw_score FROM corpus",
    "dispatch_modes": f"""SELECT * FROM (WITH {CORPUS}, {normalized("SELECT doc_id, text FROM corpus")}
SELECT dataset, doc_id, label, clean FROM corpus JOIN clean USING (doc_id))
UNION ALL SELECT * FROM (WITH {MESSAGES}, {normalized(FLAT, mode="tweet")}
SELECT dataset, doc_id, label, clean FROM corpus JOIN clean USING (doc_id))""",
    "model_roundtrip": f"""WITH {fitted()}, {GIVEN} SELECT * FROM given""",
    "stopwords_table": f"""WITH {normalized(DOCUMENTS)} SELECT doc_id, coalesce(array_to_string(
list_filter(tokens, lambda x: md5(x) >= '8'), ' '), '') AS clean FROM clean""",
    "fit_gradient": f"""WITH {TRAINED} SELECT term, 0.0::DOUBLE AS gradient FROM vocab
UNION ALL SELECT '(intercept)', 0.0::DOUBLE""",
    "ledger_rows": f"""WITH {JUDGED},
placed AS (SELECT j.*, d.source AS dataset FROM judged j JOIN documents d ON j.doc_id = d.doc_id),
runs AS ({binary("placed", "dataset")})
SELECT dataset, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1, rows FROM runs""",
    "score_given": f"""WITH {fitted()}, {GIVEN} SELECT * FROM given""",
    "stream_scores": f"""WITH {fitted()}, {GIVEN} SELECT doc_id, prediction AS label, sentiment,
probability FROM given JOIN documents USING (doc_id) WHERE length(text) >= 1""",
    "run_sizes": f"""WITH {TRAINED}
SELECT (SELECT count(*) FROM vocab) AS vocabulary_size,
  (SELECT count(*) FROM flagged WHERE NOT test) AS train_rows,
  (SELECT count(*) FROM flagged WHERE test) AS test_rows""",
    "search_one": f"""WITH {searched(frequent("'positive'"))} SELECT rank, doc_id, score, sentiment,
text FROM hits""",
    "search_top_200": f"""WITH {searched(frequent("CAST(NULL AS VARCHAR)", 200), 200)} SELECT rank,
doc_id, score, sentiment, text FROM hits""",
    "index_roundtrip": f"WITH {searched(REQUESTS)} SELECT * FROM hits",
    "stream_hits": f"WITH {searched(REQUESTS)} SELECT * FROM hits",
    "bm25_search": f"WITH {searched(frequent('CAST(NULL AS VARCHAR)'))} SELECT * FROM hits",
    "bm25_search_positive": f"""WITH {searched(frequent("'positive'"))} SELECT * FROM hits""",
    "bm25_search_many": f"WITH {searched(REQUESTS)} SELECT * FROM hits",
    "search_responses": f"""WITH {searched(REQUESTS)} SELECT a.query_id, a.query,
CAST(count(h.rank) AS INTEGER) AS count, max(h.doc_id) FILTER (h.rank = 1) AS first_doc
FROM asked a LEFT JOIN hits h ON a.query_id = h.query_id GROUP BY a.query_id, a.query""",
    "rejected_requests": f"""WITH requests AS ({REQUESTS}) SELECT * FROM (SELECT *,
CASE WHEN length(query) < 1 THEN 'empty query'
WHEN sentiment NOT IN ('positive', 'negative') THEN 'unknown sentiment'
WHEN top_k NOT BETWEEN 1 AND 50 THEN 'bad top_k' END AS reason FROM requests)
WHERE reason IS NOT NULL""",
    "grid_cells": f"""WITH {MESSAGES}, both_corpora AS (SELECT 'amazon' AS dataset, quality AS label
  FROM documents JOIN labels USING (doc_id) UNION ALL SELECT dataset, label FROM corpus),
classes AS (SELECT dataset, count(*) AS n, CAST(floor(0.2::DOUBLE * count(*) + 0.5) AS BIGINT) AS t
  FROM both_corpora GROUP BY dataset, label),
sizes AS (SELECT dataset, CAST(sum(n - t) AS BIGINT) AS train_rows, CAST(sum(t) AS BIGINT) AS test_rows
  FROM classes GROUP BY dataset)
SELECT dataset, vectorizer, reduction, train_rows, test_rows FROM sizes,
  (SELECT unnest(['bow', 'tfidf', 'bm25', 'embedding']) AS vectorizer),
  (SELECT unnest(['none', 'stem', 'lemma']) AS reduction)""",
    "class_weights": f"""WITH {JUDGED} SELECT label, n, round(sum(n) OVER () /
(count(*) OVER () * n)::DOUBLE, 6) AS weight FROM (SELECT label, count(*) AS n FROM judged
GROUP BY label)""",
    "binary_metrics": f"""WITH {JUDGED}, m AS ({binary("judged")}) SELECT
round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall,
round(f1, 6) AS f1, rows FROM m""",
    "class_report": f"""WITH {JUDGED},
one AS ({binary("judged")}),
zero AS ({binary("(SELECT 1 - label AS label, 1 - prediction AS prediction FROM judged)")}),
both_classes AS (SELECT 'negative' AS class, precision, recall, f1,
  (SELECT count(*) FROM judged WHERE label = 0) AS support FROM zero
  UNION ALL SELECT 'positive', precision, recall, f1,
  (SELECT count(*) FROM judged WHERE label = 1) FROM one),
lines AS (SELECT * FROM both_classes
  UNION ALL SELECT 'accuracy', accuracy, accuracy, accuracy, rows FROM one
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT)
  FROM both_classes
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support),
  sum(recall * support) / sum(support), sum(f1 * support) / sum(support),
  CAST(sum(support) AS BIGINT) FROM both_classes)
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
support FROM lines""",
    "grid_summary": f"""WITH {JUDGED},
placed AS (SELECT j.*, d.source FROM judged j JOIN documents d ON j.doc_id = d.doc_id),
runs AS ({binary("placed", "source")})
SELECT count(*) AS rows, round(max(f1), 6) AS best_f1, round(max(accuracy), 6) AS best_accuracy,
max(rows) AS best_vocabulary_size FROM runs""",
}
# The class report three times: whole from two sinks, one line from the third.
ORACLES["sink_roundtrips"] = f"""SELECT 'csv' AS sink, * FROM ({ORACLES["class_report"]})
UNION ALL SELECT 'report', * FROM ({ORACLES["class_report"]})
UNION ALL SELECT 'json', * FROM ({ORACLES["class_report"]}) WHERE class = 'accuracy'"""
