"""Plain SQL for the registered queries, built from shared common table expressions."""

from __future__ import annotations

from wordloom.plans.settings import (
    BATCH, COOC_MIN_COUNT, CONTEXT, FILE_BATCHES, LM_MIN_COUNT, NEGATIVE, PHRASE_MIN_COUNT,
    PHRASE_THRESHOLD, SAMPLE, SEED, SMOOTHING, SVD_K, TOP_N, W2V_CHUNK_WORDS, W2V_MIN_COUNT, W2V_WINDOW,
    WINDOW,
)

SENT = "doc_id, line_no, sent_no"

# The word-splitting rules in the SQL engine's regular-expression syntax.
SQL_TREEBANK: list[tuple[str, str]] = [
    (r'(?m)^"', "``"),
    (r"``", " `` "),
    (r'([ (\[{<])"', r"\1 `` "),
    (r"([:,])([^0-9])", r" \1 \2"),
    (r"(?m)([:,])$", r" \1 "),
    (r"\.\.\.|[;@#$%&]", r" \0 "),
    (r"""(?m)([^.\n])(\.)([\])}>"']*)[ \t]*$""", r"\1 \2\3 "),
    (r"[?!]", r" \0 "),
    (r"([^'\n])' ", r"\1 ' "),
    (r"[\]\[(){}<>]|--", r" \0 "),
    (r"\n", " \n "),
    (r'"', " '' "),
    (r"(\S)('')", r"\1 \2 "),
    (r"([^' ])('[sS]|'[mM]|'[dD]|') ", r"\1 \2 "),
    (r"([^' ])('ll|'LL|'re|'RE|'ve|'VE|n't|N'T) ", r"\1 \2 "),
    (r"(?i)\b(can)(not)\b", r" \1 \2 "),
    (r"(?i)\b(d)('ye)\b", r" \1 \2 "),
    (r"(?i)\b(gim)(me)\b", r" \1 \2 "),
    (r"(?i)\b(gon)(na)\b", r" \1 \2 "),
    (r"(?i)\b(got)(ta)\b", r" \1 \2 "),
    (r"(?i)\b(lem)(me)\b", r" \1 \2 "),
    (r"(?i)\b(mor)('n)\b", r" \1 \2 "),
    (r"(?i)\b(wan)(na)\s", r" \1 \2 "),
    (r"(?i) ('t)(is|was)\b", r" \1 \2 "),
]
SPACE = (
    r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
LETTERS = r"\p{L}\p{M}\p{Nl}"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def replace(expr: str, pattern: str, replacement: str) -> str:
    return f"regexp_replace({expr}, {quote(pattern)}, {quote(replacement)}, 'g')"


def hash32(*keys: str) -> str:
    text = "concat_ws('|', " + ", ".join([f"'{SEED}'", *keys]) + ")"
    return f"('0x' || substr(md5({text}), 1, 8))::BIGINT"


def lines(split: bool = False) -> str:
    blank = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    named = ""
    if split:
        b = hash32("doc_id", "line_no")
        named = (
            f", CASE WHEN ({b} % 101) / 100.0::DOUBLE < 0.8::DOUBLE THEN 'train'"
            f" WHEN ({b} % 101) / 100.0::DOUBLE < 0.8::DOUBLE + 0.1::DOUBLE THEN 'test'"
            " ELSE 'validate' END AS split"
        )
    return f"""
raw_lines AS (
  SELECT doc_id, (generate_subscripts(parts, 1) - 1)::INTEGER AS line_no, unnest(parts) AS raw
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)),
lines AS (
  SELECT doc_id, line_no, trim(raw, {blank}) AS line{named}
  FROM raw_lines WHERE trim(raw, {blank}) <> '')"""


def _xlogy(x: str, y: str) -> str:
    return f"(CASE WHEN {x} = 0 THEN 0.0 ELSE {x} * ln({y}) END)"


def _association(a: str, b: str, ab: str, n: str) -> str:
    p2 = f"(CASE WHEN {n} > {a} THEN ({b} - {ab}) / ({n} - {a}) ELSE 0.0 END)"
    cells = [f"{ab}", f"({a} - {ab})", f"({b} - {ab})", f"({n} - {a} - {b} + {ab})"]
    joint = " + ".join(_xlogy(c, q) for c, q in zip(cells, [f"({b} / {n})", f"(1 - {b} / {n})"] * 2))
    apart = " + ".join(_xlogy(c, q) for c, q in zip(cells, [f"({ab} / {a})", f"(1 - {ab} / {a})", p2, f"(1 - {p2})"]))
    return f"(-2.0 * (({joint}) - ({apart})))"


def sentence_model() -> str:
    """CTEs ``st_words``, ``st_types`` and ``st_pairs`` of the learned sentence model."""
    opening, closing, pause = "(\"''\\[{«“‘¿¡", ")\"''\\]}»”’", ",;:"
    core = f"regexp_replace(regexp_replace(w, '^[{opening}]+', ''), '[{closing}{pause}]+$', '')"
    initial = r"(length(typ) = 1 AND regexp_matches(typ, '\p{L}'))"
    score = (
        f"-2.0 * (({_xlogy('np', '(P / N)')} + {_xlogy('(n - np)', '(1 - P / N)')})"
        f" - ({_xlogy('np', '0.99::DOUBLE')} + {_xlogy('(n - np)', '(1 - 0.99::DOUBLE)')}))"
        " * exp(-letters::DOUBLE) * (length(typ) - letters + 1) * pow(letters::DOUBLE, -(n - np)::DOUBLE)"
    )
    return rf"""{lines()},
st_raw AS (
  SELECT doc_id, line_no, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
  FROM (SELECT doc_id, line_no, list_filter(string_split({replace('line', SPACE, ' ')}, ' '), lambda t: t <> '') AS ws FROM lines)),
st_core AS (
  SELECT *, core LIKE '%.' AND NOT core LIKE '%..' AS dotted, regexp_matches(w, '[{pause}][{closing}{pause}]*$') AS pauses
  FROM (SELECT *, {core} AS core FROM st_raw)),
st_words AS MATERIALIZED (
  SELECT doc_id, line_no, i, w, CASE WHEN regexp_matches(bare, '^[0-9][0-9.,]*$') THEN '#' ELSE bare END AS typ,
         CASE WHEN regexp_matches(core, '^\p{{Lu}}') THEN 'upper' WHEN regexp_matches(core, '^\p{{Ll}}') THEN 'lower' ELSE 'none' END AS kase,
         CASE WHEN dotted AND pauses THEN 'paused' WHEN dotted THEN 'period' WHEN regexp_matches(core, '[!?]$') AND NOT pauses THEN 'mark' ELSE 'plain' END AS fin
  FROM (SELECT *, lower(CASE WHEN dotted THEN core[:-2] ELSE core END) AS bare FROM st_core)),
st_two AS MATERIALIZED (
  SELECT *, lag(typ) OVER g AS ptyp, lag(fin) OVER g AS pfin FROM st_words WINDOW g AS (PARTITION BY doc_id, line_no ORDER BY i)),
st_count AS (
  SELECT typ, count(*) AS n, count(*) FILTER (fin IN ('period', 'paused')) AS np,
         count(*) FILTER ((pfin IS NULL OR pfin = 'mark') AND kase = 'upper') AS ub, count(*) FILTER ((pfin IS NULL OR pfin = 'mark') AND kase = 'lower') AS lb,
         count(*) FILTER (pfin = 'plain' AND kase = 'upper') AS ui, count(*) FILTER (pfin = 'plain' AND kase = 'lower') AS li
  FROM st_two GROUP BY typ),
st_total AS (SELECT sum(n)::DOUBLE AS N_, sum(np)::DOUBLE AS P_ FROM st_count),
st_score AS MATERIALIZED (
  SELECT * EXCLUDE (letters), coalesce(score >= 0.3, false) AS abbr FROM (
    SELECT *, CASE WHEN regexp_matches(typ, '\p{{L}}') AND np > 0 AND P_ < N_ THEN {score.replace('P / N', 'P_ / N_')} END AS score
    FROM (SELECT *, length(replace(typ, '.', '')) AS letters FROM st_count, st_total))),
st_around AS MATERIALIZED (
  SELECT a.*, s.abbr, s.n AS n_typ, NOT s.abbr AND NOT paused AS ends
  FROM (SELECT ptyp AS typ, pfin = 'paused' AS paused, typ AS next, kase, count(*) AS c FROM st_two WHERE pfin IN ('period', 'paused') GROUP BY ALL) a
  JOIN st_score s USING (typ)),
st_breaks AS (SELECT coalesce(sum(c), 0)::DOUBLE AS B_ FROM st_around WHERE ends),
st_next AS (
  SELECT next AS typ, sum(c) FILTER (ends AND typ <> '#' AND NOT {initial}) AS nw,
         sum(c) FILTER (ends AND kase = 'upper') AS um, sum(c) FILTER (ends AND kase = 'lower') AS lm,
         sum(c) FILTER (NOT ends AND kase = 'lower') AS lu, sum(c) FILTER (NOT ends AND kase = 'upper') AS uu
  FROM st_around GROUP BY next),
st_types AS MATERIALIZED (
  SELECT *, often AND linked >= 30 AS starter FROM (
    SELECT *, CASE WHEN often THEN {_association('B_', 'n::DOUBLE', 'nw', 'N_')} END AS linked FROM (
      SELECT typ, n, np, score, abbr, N_, B_, coalesce(nw, 0)::DOUBLE AS nw, coalesce(nw, 0) > 0 AND regexp_matches(typ, '\p{{L}}') AND N_ * coalesce(nw, 0) > n * B_ AS often,
             ub + coalesce(um, 0) AS ub, lb + coalesce(lm, 0) AS lb, ui, li + coalesce(lu, 0) AS li, coalesce(uu, 0) AS uu
      FROM st_score LEFT JOIN st_next USING (typ), st_breaks))),
st_pairs AS MATERIALIZED (
  SELECT * FROM (
    SELECT p.typ, p.next, p.c AS n, {_association('p.a', 't.n::DOUBLE', 'p.c::DOUBLE', 'N_')} AS score
    FROM (SELECT typ, next, n_typ::DOUBLE AS a, sum(c)::BIGINT AS c FROM st_around WHERE NOT paused AND (abbr OR typ = '#' OR {initial}) GROUP BY ALL) p
    JOIN st_types t ON t.typ = p.next
    WHERE p.c > 1 AND regexp_matches(p.next, '[\p{{L}}#]') AND N_ * p.c > p.a * t.n)
  WHERE score >= 7.88)"""


def sentences_trained() -> str:
    initial = r"(length(typ) = 1 AND regexp_matches(typ, '\p{L}'))"
    return f"""WITH {sentence_model()},
st_ahead AS (
  SELECT *, lead(typ) OVER g AS next, lead(kase) OVER g AS nkase FROM st_words WINDOW g AS (PARTITION BY doc_id, line_no ORDER BY i)),
st_known AS (
  SELECT a.*, t.abbr, x.starter, x.ub + x.ui + x.uu AS uppers, x.lb + x.li AS lowers, x.ui, x.lb, c.next IS NOT NULL AS together, {initial.replace('typ', 'a.typ')} AS initial
  FROM st_ahead a JOIN st_types t ON t.typ = a.typ LEFT JOIN st_types x ON x.typ = a.next LEFT JOIN st_pairs c ON c.typ = a.typ AND c.next = a.next),
st_told AS (
  SELECT *, nkase = 'upper' AND lowers > 0 AND ui = 0 AS begins, nkase = 'lower' AND (uppers > 0 OR lb = 0) AS goes_on FROM st_known),
st_ended AS (
  SELECT *, CASE WHEN next IS NULL THEN false WHEN fin = 'mark' THEN true WHEN fin <> 'period' THEN false WHEN together THEN false
    WHEN abbr AND NOT initial THEN begins OR (nkase = 'upper' AND starter)
    WHEN initial OR typ = '#' THEN NOT abbr AND NOT goes_on AND NOT (initial AND NOT begins AND nkase = 'upper' AND lowers = 0)
    ELSE true END AS ended
  FROM st_told),
st_sent AS (
  SELECT *, coalesce(sum(ended::INTEGER) OVER (PARTITION BY doc_id, line_no ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM st_ended)
SELECT doc_id, line_no, s::INTEGER AS sent_no, string_agg(w, ' ' ORDER BY i) AS sentence FROM st_sent GROUP BY doc_id, line_no, s"""


def sentences(mode: str = "treebank", clean: bool = True, split: bool = False) -> str:
    marked = replace("line", SPACE, " ")
    marked = replace(marked, r"([.!?]) +", "\\1\n")
    if mode == "treebank":
        for pattern, replacement in SQL_TREEBANK:
            marked = replace(marked, pattern, replacement)
            if pattern == r"\n":
                marked = f"(' ' || {marked} || ' ')"
    if clean:
        marked = replace(f"lower({marked})", f"[^{LETTERS} \\n]", "")
    also = ", split" if split else ""
    return f"""{lines(split)},
parts AS (
  SELECT doc_id, line_no{also}, (generate_subscripts(p, 1) - 1)::INTEGER AS sent_no, unnest(p) AS s
  FROM (SELECT doc_id, line_no{also}, string_split({marked}, chr(10)) AS p FROM lines)),
sents AS MATERIALIZED (
  SELECT * FROM (
    SELECT doc_id, line_no{also}, sent_no,
           list_filter(string_split_regex(s, ' +'), lambda t: t <> '') AS toks FROM parts)
  WHERE len(toks) > 0)"""


def tokens(mode: str = "treebank", split: bool = False) -> str:
    also = "split, " if split else ""
    return f"""{sentences(mode, split=split)},
tokens AS MATERIALIZED (
  SELECT {also}{SENT}, (generate_subscripts(toks, 1) - 1)::INTEGER AS pos, unnest(toks) AS tok
  FROM sents)"""


def vocab(min_count: int, source: str = "tokens", name: str = "vocab") -> str:
    return f"""
{name} AS MATERIALIZED (
  SELECT tok, (row_number() OVER (ORDER BY n DESC, tok) - 1)::INTEGER AS id, n
  FROM (SELECT tok, count(*) AS n FROM {source} GROUP BY tok) WHERE n >= {min_count})"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts)


def phrase_pass(source: str, k: int) -> str:
    """Learn phrases on ``source`` and merge them: CTEs ``phrases{k}`` and ``merged{k}``."""
    return f"""
next{k} AS MATERIALIZED (
  SELECT *, lead(tok) OVER (PARTITION BY {SENT} ORDER BY pos) AS nxt FROM {source}),
uni{k} AS (SELECT tok, count(*) AS n FROM {source} GROUP BY tok),
bi{k} AS (SELECT tok AS a, nxt AS b, count(*) AS n FROM next{k} WHERE nxt IS NOT NULL GROUP BY ALL),
phrases{k} AS MATERIALIZED (
  SELECT a, b, (bi.n - {PHRASE_MIN_COUNT})::DOUBLE / ua.n / ub.n
         * ((SELECT count(*) FROM uni{k}) + (SELECT count(*) FROM bi{k})) AS score
  FROM bi{k} bi JOIN uni{k} ua ON ua.tok = a JOIN uni{k} ub ON ub.tok = b
  WHERE (bi.n - {PHRASE_MIN_COUNT})::DOUBLE / ua.n / ub.n
        * ((SELECT count(*) FROM uni{k}) + (SELECT count(*) FROM bi{k})) > {PHRASE_THRESHOLD}),
flag{k} AS (
  SELECT n.*, pos - row_number() OVER (PARTITION BY {SENT} ORDER BY pos) AS run
  FROM next{k} n JOIN phrases{k} p ON p.a = n.tok AND p.b = n.nxt),
open{k} AS (
  SELECT {SENT}, pos FROM (
    SELECT *, row_number() OVER (PARTITION BY {SENT}, run ORDER BY pos) AS i FROM flag{k})
  WHERE i % 2 = 1),
merged{k} AS MATERIALIZED (
  SELECT {SENT}, (row_number() OVER (PARTITION BY {SENT} ORDER BY pos) - 1)::INTEGER AS pos, tok FROM (
    SELECT n.doc_id, n.line_no, n.sent_no, n.pos,
           CASE WHEN o.pos IS NULL THEN n.tok ELSE n.tok || '_' || n.nxt END AS tok
    FROM next{k} n
    LEFT JOIN open{k} o ON o.doc_id = n.doc_id AND o.line_no = n.line_no
      AND o.sent_no = n.sent_no AND o.pos = n.pos
    LEFT JOIN open{k} c ON c.doc_id = n.doc_id AND c.line_no = n.line_no
      AND c.sent_no = n.sent_no AND c.pos = n.pos - 1
    WHERE c.pos IS NULL))"""


def joined_sentences(source: str) -> str:
    return f"SELECT {SENT}, string_agg(tok, ' ' ORDER BY pos) AS sentence FROM {source} GROUP BY {SENT}"


def examples() -> str:
    lags = "".join(
        f", lag(id, {CONTEXT - i}) OVER (PARTITION BY {SENT} ORDER BY pos) AS w{i}"
        for i in range(CONTEXT)
    )
    xs = ", ".join(f"{i}::BIGINT * v + w{i}" for i in range(CONTEXT))
    return with_(
        tokens(split=True),
        vocab(LM_MIN_COUNT),
        f"""
known AS (SELECT t.split, t.doc_id, t.line_no, t.sent_no, t.pos, id
          FROM tokens t JOIN vocab USING (tok)),
grams AS (SELECT *{lags} FROM known),
examples AS MATERIALIZED (
  SELECT split, row_number() OVER (PARTITION BY split ORDER BY {SENT}, pos) - 1 AS ex_id,
         concat_ws(',', {xs}) AS x_idx, id AS y, {", ".join(f"w{i}" for i in range(CONTEXT))}
  FROM grams, (SELECT count(*) AS v FROM vocab) WHERE w0 IS NOT NULL),
sized AS (SELECT *, count(*) OVER (PARTITION BY split) AS total FROM examples),
batched AS MATERIALIZED (
  SELECT split, ex_id, x_idx, y, ex_id // {BATCH} AS mb_id,
         (ex_id // {BATCH} // {FILE_BATCHES})::INTEGER AS file_ix
  FROM sized WHERE ex_id // {BATCH} < total // {BATCH})""",
    )


def term_doc() -> str:
    return with_(
        tokens(),
        vocab(COOC_MIN_COUNT),
        """
doc_index AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS doc_ix FROM documents),
td AS MATERIALIZED (
  SELECT id, doc_ix, count(*)::DOUBLE AS value
  FROM tokens JOIN vocab USING (tok) JOIN doc_index USING (doc_id) GROUP BY id, doc_ix),
idf AS (
  SELECT id, count(*) AS df, (SELECT count(*) FROM documents)::DOUBLE / count(*) AS idf
  FROM td GROUP BY id),
tfidf AS (SELECT id, doc_ix, idf * (1 + log10(value)) AS value FROM td JOIN idf USING (id))""",
    )


def cooc(smoothing: float = 1.0) -> str:
    return with_(
        tokens(),
        vocab(COOC_MIN_COUNT),
        f"""
known AS MATERIALIZED (SELECT {SENT}, pos, id FROM tokens JOIN vocab USING (tok)),
cooc AS MATERIALIZED (
  SELECT a.id AS row, b.id AS col, count(*)::DOUBLE AS value
  FROM known a JOIN known b
    ON a.doc_id = b.doc_id AND a.line_no = b.line_no AND a.sent_no = b.sent_no
   AND abs(a.pos - b.pos) BETWEEN 1 AND {WINDOW}
  GROUP BY a.id, b.id),
grand AS (SELECT sum(value) AS n FROM cooc),
rows_ AS (SELECT row, sum(value) AS total FROM cooc GROUP BY row),
cols_ AS (SELECT col, sum(value) AS total, pow(sum(value), {smoothing}) AS w FROM cooc GROUP BY col),
ppmi AS MATERIALIZED (
  SELECT c.row, c.col,
         log2(c.value / n / ((r.total / n) * (k.w / (SELECT sum(w) FROM cols_)))) AS value
  FROM cooc c JOIN rows_ r USING (row) JOIN cols_ k USING (col), grand)""",
    )


VECTORS = """
vectors AS MATERIALIZED (
  SELECT vec_id::INTEGER AS id, vec_id::VARCHAR AS tok, embedding::DOUBLE[] AS vec, label FROM embeddings)"""

CENTROIDS = f"""{VECTORS},
centroid_dims AS MATERIALIZED (
  SELECT label, dim, avg(x) AS x FROM (
    SELECT label, generate_subscripts(vec, 1) AS dim, unnest(vec) AS x FROM vectors)
  GROUP BY label, dim),
centroids AS MATERIALIZED (
  SELECT label, list(x ORDER BY dim) AS vec FROM centroid_dims GROUP BY label),
dim_var AS (SELECT dim, var_samp(x) AS v FROM centroid_dims GROUP BY dim),
distances AS MATERIALIZED (
  SELECT p.label::BIGINT AS a, q.label::BIGINT AS b, sqrt(sum((p.x - q.x) ** 2 / v)) AS distance
  FROM centroid_dims p JOIN centroid_dims q ON p.dim = q.dim AND p.label < q.label
  JOIN dim_var d ON d.dim = p.dim GROUP BY p.label, q.label)"""


def neighbours(score: str, probes: str) -> str:
    """Top neighbours of every vector in ``probes`` (a condition on alias ``p``)."""
    return f"""{with_(VECTORS)}
SELECT word, neighbor, round(similarity, 6) AS similarity, rank FROM (
  SELECT p.tok AS word, o.tok AS neighbor, {score} AS similarity,
         row_number() OVER (PARTITION BY p.id ORDER BY {score} DESC, o.id)::INTEGER AS rank
  FROM vectors p JOIN vectors o ON p.id <> o.id WHERE {probes})
WHERE rank <= {TOP_N}"""


COSINE = "list_cosine_similarity(p.vec, o.vec)"
EUCLID = "-list_distance(p.vec, o.vec)"
GROUP_HEADS = "p.id IN (SELECT min(id) FROM vectors GROUP BY label)"


def oracle_sql() -> dict[str, str]:
    tok = with_(tokens())
    tok20 = with_(tokens(), vocab(COOC_MIN_COUNT))
    tok_w2v = with_(tokens(), vocab(W2V_MIN_COUNT))
    ex, td, cc = examples(), term_doc(), cooc()
    phrase = with_(tokens(), phrase_pass("tokens", 1))
    phrase2 = with_(tokens(), phrase_pass("tokens", 1), phrase_pass("merged1", 2))
    out: dict[str, str] = {}

    # sources and text
    out["read_lines"] = f"{with_(lines())} SELECT doc_id, line_no, line FROM lines"
    out["document_index"] = (
        "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS doc_ix FROM documents"
    )
    h = hash32("0", "doc_id")
    out["shuffled_document_order"] = (
        f"SELECT doc_id, row_number() OVER (ORDER BY {h}, doc_id) - 1 AS shuffle_ix FROM documents"
    )
    split = with_(lines(split=True))
    out["corpus_split"] = f"{split} SELECT doc_id, line_no, split FROM lines"
    out["corpus_split_counts"] = f"{split} SELECT split, count(*) AS n FROM lines GROUP BY split"
    out["sentence_model"] = f"""WITH {sentence_model()}
SELECT 'abbreviation' AS kind, typ, NULL::VARCHAR AS next, np AS n, round(score, 6) + 0.0 AS score FROM st_types WHERE abbr
UNION ALL SELECT 'starter', typ, NULL, n, round(linked, 6) + 0.0 FROM st_types WHERE starter
UNION ALL SELECT 'collocation', typ, next, n, round(score, 6) + 0.0 FROM st_pairs"""
    out["sentences_trained"] = sentences_trained()
    out["sentences"] = (
        f"{with_(sentences())} SELECT {SENT}, array_to_string(toks, ' ') AS sentence FROM sents"
    )
    out["tokens"] = f"{with_(tokens('whitespace'))} SELECT {SENT}, pos, tok FROM tokens"
    out["tokens_treebank"] = f"{tok} SELECT {SENT}, pos, tok FROM tokens"
    cleaned = replace("lower(t)", f"[^{LETTERS}0-9 ]", "")
    out["clean_tokens"] = f"""{with_(sentences("whitespace", clean=False))},
cleaned AS (
  SELECT {SENT}, list_filter(list_transform(toks, lambda t: {cleaned}), lambda t: t <> '') AS toks
  FROM sents)
SELECT {SENT}, (generate_subscripts(toks, 1) - 1)::INTEGER AS pos, unnest(toks) AS tok
FROM cleaned WHERE len(toks) > 0"""

    # vocabulary
    out["token_counts"] = f"{tok} SELECT tok, count(*) AS n FROM tokens GROUP BY tok"
    out["vocab_min_count"] = f"{out['token_counts']} HAVING count(*) >= {COOC_MIN_COUNT}"
    out["vocabulary"] = f"{tok20} SELECT tok, id, n FROM vocab"
    out["vocab_roundtrip"] = out["vocabulary"]
    out["vocab_size"] = f"{tok20} SELECT count(*) AS vocab_size FROM vocab"
    out["encode_tokens"] = f"{tok20} SELECT {SENT}, pos, id FROM tokens JOIN vocab USING (tok)"
    out["in_vocab_tokens"] = (
        f"{tok20} SELECT {SENT}, pos, tok FROM tokens WHERE tok IN (SELECT tok FROM vocab)"
    )
    out["oov_tokens"] = f"{out['token_counts']} HAVING count(*) < {COOC_MIN_COUNT}"

    # phrases
    out["bigram_counts"] = f"{phrase} SELECT a, b, n FROM bi1"
    out["phrase_scores"] = f"{phrase} SELECT a, b, round(score, 6) AS score FROM phrases1"
    out["apply_phrases"] = f"{phrase} {joined_sentences('merged1')}"
    out["phrases_two_pass"] = f"{phrase2} {joined_sentences('merged2')}"

    # contexts and examples
    window = f"OVER (PARTITION BY {SENT} ORDER BY pos ROWS BETWEEN"
    out["target_context_pairs"] = f"""{tok20},
known AS (SELECT * FROM tokens WHERE tok IN (SELECT tok FROM vocab))
SELECT {SENT}, pos, tok AS target,
       concat_ws(' ', string_agg(tok, ' ') {window} 2 PRECEDING AND 1 PRECEDING),
                      string_agg(tok, ' ') {window} 1 FOLLOWING AND 2 FOLLOWING)) AS ctx
FROM known"""
    before = f"""{with_(tokens(), vocab(LM_MIN_COUNT))},
known AS (SELECT * FROM tokens WHERE tok IN (SELECT tok FROM vocab)),
pairs AS (
  SELECT {SENT}, pos, tok AS target,
         count(*) {window} {CONTEXT} PRECEDING AND 1 PRECEDING) AS n_ctx,
         coalesce(string_agg(tok, ' ') {window} {CONTEXT} PRECEDING AND 1 PRECEDING), '') AS ctx
  FROM known)
SELECT {SENT}, pos, target, ctx FROM pairs"""
    out["lm_contexts"] = before
    out["lm_examples"] = f"{before} WHERE n_ctx = {CONTEXT}"
    out["lm_examples_encoded"] = f"{ex} SELECT split, ex_id, x_idx, y FROM examples"
    slots = " UNION ALL ".join(
        f"SELECT split, ex_id, {i} AS slot, w{i}::BIGINT AS word_id FROM examples" for i in range(CONTEXT)
    )
    out["examples_decoded"] = f"{ex} {slots}"
    out["minibatches"] = f"{ex} SELECT split, ex_id, mb_id, file_ix, x_idx, y FROM batched"
    mixed = hash32("ex_id")
    out["minibatch_shuffled"] = f"""{ex}
SELECT split, mb_id, ex_id,
       (row_number() OVER (PARTITION BY split, mb_id ORDER BY {mixed}, ex_id) - 1)::INTEGER AS slot
FROM batched"""
    mixed = hash32("mb_id")
    out["minibatch_files"] = f"""{ex},
batches AS (SELECT split, file_ix, mb_id, count(*) AS n_examples FROM batched GROUP BY ALL)
SELECT split, file_ix, mb_id, n_examples,
       (row_number() OVER (PARTITION BY split, file_ix ORDER BY {mixed}, mb_id) - 1)::INTEGER AS file_slot
FROM batches"""

    # term-document matrix
    out["term_document_counts"] = f"{td} SELECT id, doc_ix, value FROM td"
    out["model_roundtrip_term_document"] = f"""{td}
SELECT tok, doc_id, value FROM td JOIN vocab USING (id) JOIN doc_index USING (doc_ix)"""
    out["term_vector"] = f"""{td}
SELECT doc_ix, coalesce(value, 0.0)::DOUBLE AS value
FROM doc_index LEFT JOIN (SELECT * FROM td WHERE id = 10) USING (doc_ix)"""
    first_doc = "(SELECT doc_ix FROM doc_index WHERE doc_id = (SELECT min(doc_id) FROM documents))"
    out["document_vector"] = f"""{td}
SELECT id, coalesce(value, 0.0)::DOUBLE AS value
FROM vocab LEFT JOIN (SELECT * FROM td WHERE doc_ix = {first_doc}) USING (id)"""
    out["item_vector"] = f"""{td}
SELECT 'word' AS kind, doc_ix AS ix, coalesce(value, 0.0)::DOUBLE AS value
FROM doc_index LEFT JOIN (SELECT * FROM td WHERE id = 10) USING (doc_ix)
UNION ALL
SELECT 'document', id::BIGINT, coalesce(value, 0.0)::DOUBLE
FROM vocab LEFT JOIN (SELECT * FROM td WHERE doc_ix = {first_doc}) USING (id)"""
    out["log_tf"] = f"{td} SELECT id, doc_ix, round(1 + log10(value), 6) AS value FROM td"
    out["idf"] = f"{td} SELECT id, df, round(idf, 6) AS idf FROM idf"
    out["tfidf"] = f"{td} SELECT id, doc_ix, round(value, 6) AS value FROM tfidf"
    out["top_terms_per_document"] = f"""{td}
SELECT doc_id, tok, round(value, 6) AS value, rank FROM (
  SELECT doc_id, tok, value,
         row_number() OVER (PARTITION BY doc_id ORDER BY round(value, 6) DESC, id)::INTEGER AS rank
  FROM tfidf JOIN vocab USING (id) JOIN doc_index USING (doc_ix))
WHERE rank <= {TOP_N}"""

    # word-word matrix
    out["cooccurrence"] = f"{cc} SELECT row, col, value FROM cooc"
    out["model_roundtrip_word_word"] = f"""{cc}
SELECT r.tok AS word, c.tok AS context, value
FROM cooc JOIN vocab r ON r.id = row JOIN vocab c ON c.id = col"""
    out["context_vector"] = f"""{cc}
SELECT id, coalesce(value, 0.0)::DOUBLE AS value
FROM vocab LEFT JOIN (SELECT col AS id, value FROM cooc WHERE row = 10) USING (id)"""
    out["cooc_marginals"] = f"{cc} SELECT row, total, round(total / n, 9) AS p FROM rows_, grand"
    smooth = cooc(SMOOTHING)
    out["context_distribution"] = f"""{smooth}
SELECT col, total, round(w / (SELECT sum(w) FROM cols_), 9) AS p FROM cols_"""
    positive = "SELECT row, col, round(value, 6) AS value FROM ppmi WHERE round(value, 6) > 0"
    out["ppmi"] = f"{cc} {positive}"
    out["ppmi_smoothed"] = f"{smooth} {positive}"
    out["most_similar_ppmi"] = f"""{cc},
pos AS (SELECT row, col, value FROM ppmi WHERE value > 0),
norms AS (SELECT row, sqrt(sum(value * value)) AS norm FROM pos GROUP BY row),
dots AS (SELECT o.row, sum(o.value * p.value) AS dot
         FROM pos o JOIN pos p ON p.col = o.col AND p.row = 10 WHERE o.row <> 10 GROUP BY o.row),
sims AS (SELECT row, coalesce(dot, 0) / norm / (SELECT norm FROM norms WHERE row = 10) AS similarity
         FROM norms LEFT JOIN dots USING (row) WHERE row <> 10)
SELECT (SELECT tok FROM vocab WHERE id = 10) AS word, tok AS neighbor,
       round(similarity, 6) AS similarity,
       row_number() OVER (ORDER BY similarity DESC, row)::INTEGER AS rank
FROM sims JOIN vocab ON id = row ORDER BY similarity DESC, row LIMIT {TOP_N}"""
    out["most_similar_sparse_dot"] = f"""{cc},
pos AS (SELECT row, col, value FROM ppmi WHERE value > 0),
dots AS (SELECT o.row AS id, sum(o.value * p.value) AS dot
         FROM pos o JOIN pos p ON p.col = o.col AND p.row = 10 WHERE o.row <> 10 GROUP BY o.row)
SELECT (SELECT tok FROM vocab WHERE id = 10) AS word, tok AS neighbor, round(coalesce(dot, 0.0), 6) AS similarity,
       row_number() OVER (ORDER BY coalesce(dot, 0.0) DESC, id)::INTEGER AS rank
FROM vocab LEFT JOIN dots USING (id) WHERE id <> 10 ORDER BY rank LIMIT {TOP_N}"""
    out["most_similar_tfidf"] = f"""{td},
norms AS (SELECT id, sqrt(sum(value * value)) AS norm FROM tfidf GROUP BY id),
dots AS (SELECT o.id, sum(o.value * p.value) AS dot
         FROM tfidf o JOIN tfidf p ON p.doc_ix = o.doc_ix AND p.id = 10 WHERE o.id <> 10 GROUP BY o.id),
sims AS (SELECT id, coalesce(dot, 0) / (norm * (SELECT norm FROM norms WHERE id = 10)) AS similarity
         FROM norms LEFT JOIN dots USING (id) WHERE id <> 10 AND norm > 0)
SELECT (SELECT tok FROM vocab WHERE id = 10) AS word, tok AS neighbor, round(similarity, 6) AS similarity,
       row_number() OVER (ORDER BY similarity DESC, id)::INTEGER AS rank
FROM sims JOIN vocab USING (id) ORDER BY rank LIMIT {TOP_N}"""
    out["svd_rows"] = f"""{cc}
SELECT id, {SVD_K} AS dims, NOT EXISTS (SELECT 1 FROM ppmi WHERE row = vocab.id AND value > 0) AS is_zero FROM vocab"""
    out["svd_orthonormality"] = f"""
SELECT i::INTEGER AS i, j::INTEGER AS j, CASE WHEN i = j THEN 1.0 ELSE 0.0 END::DOUBLE AS value
FROM range({SVD_K}) a(i), range({SVD_K}) b(j)"""
    out["svd_residual"] = f"SELECT i::INTEGER AS dim, 0.0::DOUBLE AS residual FROM range({SVD_K}) a(i)"

    # vectors
    out["cosine_pairs"] = f"""{with_(CENTROIDS)}
SELECT id, round(list_cosine_similarity(v.vec, c.vec), 6) AS similarity
FROM vectors v JOIN centroids c USING (label)"""
    out["most_similar_dense"] = neighbours(COSINE, "p.id = (SELECT min(id) FROM vectors)")
    out["most_similar_euclidean"] = neighbours(EUCLID, "p.id = (SELECT min(id) FROM vectors)")
    out["most_similar_batch"] = neighbours(COSINE, GROUP_HEADS)
    out["vectors_for_words"] = f"""{with_(VECTORS)}
SELECT p.id, p.tok, len(p.vec)::INTEGER AS dims, round(list_sum(p.vec), 6) AS total
FROM vectors p WHERE {GROUP_HEADS}"""
    out["pca_variance"] = """
SELECT count(*) AS n_vectors, 0.0::DOUBLE AS mean_1, 0.0::DOUBLE AS mean_2, 0.0::DOUBLE AS covariance,
       true AS in_order, true AS within_total FROM embeddings"""
    out["seuclidean_distances"] = (
        f"{with_(CENTROIDS)} SELECT a, b, round(distance, 6) AS distance FROM distances"
    )
    # one pair at a time: the nearest two clusters by the largest distance of their members
    recursive = with_(CENTROIDS).replace("WITH", "WITH RECURSIVE", 1)
    out["complete_linkage"] = f"""{recursive},
steps AS (
  SELECT 0 AS step, label::BIGINT AS point, label::BIGINT AS cluster, NULL::BIGINT AS a, NULL::BIGINT AS b, 0.0::DOUBLE AS height FROM centroids
  UNION ALL
  SELECT r.step + 1, r.point, CASE WHEN r.cluster = m.b THEN m.a ELSE r.cluster END, m.a, m.b, m.height
  FROM steps r, (
    SELECT least(x.cluster, y.cluster) AS a, greatest(x.cluster, y.cluster) AS b, max(distance) AS height
    FROM steps x JOIN distances d ON x.point = d.a JOIN steps y ON y.point = d.b
    WHERE x.cluster <> y.cluster GROUP BY 1, 2 ORDER BY height, 1, 2 LIMIT 1) m)
SELECT a, b, round(max(height), 6) AS height, count(*) FILTER (cluster = a) AS size
FROM steps WHERE step > 0 GROUP BY step, a, b"""
    out["complete_linkage_top"] = f"""{with_(CENTROIDS)}
SELECT (SELECT count(*) FROM centroids) - 1 AS merges, (SELECT count(*) FROM centroids) AS root_size,
       round(max(distance), 6) AS root_height FROM distances"""
    out["word_group_cohesion"] = f"""{with_(VECTORS)},
pairs AS (
  SELECT p.label, o.label = p.label AS same, {COSINE} AS sim FROM vectors p JOIN vectors o ON p.id <> o.id)
SELECT label, (SELECT count(*) FROM vectors v WHERE v.label = pairs.label) AS n,
       round(avg(sim) FILTER (same), 6) AS within, round(avg(sim) FILTER (NOT same), 6) AS between
FROM pairs GROUP BY label"""

    # word2vec data
    merged = with_(tokens(), phrase_pass("tokens", 1), vocab(W2V_MIN_COUNT, "merged1"))
    out["w2v_vocab"] = f"{merged} SELECT tok, id, n FROM vocab"
    kept = f"""{tok_w2v},
total AS (SELECT sum(n)::DOUBLE AS total FROM vocab),
kept AS MATERIALIZED (
  SELECT {SENT}, pos, id, n / total AS f,
         {hash32("'sample'", "0", "doc_id", "line_no", "sent_no", "pos")} / 4294967296.0::DOUBLE AS u
  FROM tokens JOIN vocab USING (tok), total),
sampled AS MATERIALIZED (
  SELECT {SENT}, pos, id FROM kept WHERE u < sqrt({SAMPLE}::DOUBLE / f) + {SAMPLE}::DOUBLE / f)"""
    out["w2v_subsample"] = f"{kept} SELECT {SENT}, pos, id FROM sampled"
    reach = ", ".join(str(k) for k in range(-W2V_WINDOW, W2V_WINDOW + 1) if k)
    near = f"""{kept},
numbered AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY {SENT} ORDER BY pos) AS i,
         1 + {hash32("'window'", "0", "doc_id", "line_no", "sent_no", "pos")} % {W2V_WINDOW} AS width
  FROM sampled),
pairs AS MATERIALIZED (
  SELECT c.doc_id, c.line_no, c.sent_no, c.pos, c.id AS center, o.id AS context,
         row_number() OVER (PARTITION BY c.doc_id, c.line_no, c.sent_no, c.pos ORDER BY o.i) - 1 AS nth
  FROM (SELECT *, unnest([{reach}]) AS k FROM numbered) c JOIN numbered o
    ON c.doc_id = o.doc_id AND c.line_no = o.line_no AND c.sent_no = o.sent_no AND o.i = c.i + c.k
  WHERE abs(c.k) <= c.width)"""
    out["skipgram_pairs"] = f"{near} SELECT {SENT}, pos, center, context FROM pairs"
    draws = ", ".join(
        hash32("'noise'", str(j), "0", "doc_id", "line_no", "sent_no", "pos", "nth") for j in range(NEGATIVE)
    )
    # the noise line in whole numbers, cut into 4096 parts so that draws find their stretch by equality
    line = """noise_line AS MATERIALIZED (
  SELECT id, (sum(w) OVER (ORDER BY id) - w)::BIGINT AS lo, (sum(w) OVER (ORDER BY id))::BIGINT AS hi
  FROM (SELECT id, round(pow(n, 0.75) * 1000)::BIGINT AS w FROM vocab)),
noise_size AS (SELECT max(hi) AS total, greatest(max(hi) // 4096, 1) AS step FROM noise_line),
stretches AS (SELECT id, lo, hi, unnest(generate_series(lo // step, (hi - 1) // step)) AS part FROM noise_line, noise_size)"""
    out["negative_samples"] = f"""{near}, {line},
draws AS (
  SELECT context, floor(u / 4294967296.0::DOUBLE * total)::BIGINT AS spot
  FROM (SELECT context, unnest([{draws}]) AS u FROM pairs), noise_size)
SELECT id, count(*) AS drawn
FROM (SELECT *, spot // step AS part FROM draws, noise_size) d JOIN stretches USING (part)
WHERE spot >= lo AND spot < hi AND id <> context GROUP BY id"""

    def first_step(examples: str) -> str:
        start = [f"({hash32(repr('start'), str(d), 'id')} / 4294967296.0::DOUBLE - 0.5) / 2" for d in range(2)]
        return f"""{near}, {line},
chunks AS (
  SELECT greatest(1, round(sum(least(1.0::DOUBLE, sqrt({SAMPLE}::DOUBLE / f) + {SAMPLE}::DOUBLE / f) * n) / {W2V_CHUNK_WORDS}))::BIGINT AS chunks
  FROM (SELECT n, n / total AS f FROM vocab, total)),
start AS (SELECT id, {start[0]} AS v0, {start[1]} AS v1 FROM vocab),
examples AS MATERIALIZED ({examples}),
targets AS (
  SELECT chunk, out, h0, h1, NULL AS u FROM examples
  UNION ALL SELECT chunk, out, h0, h1, unnest([{draws}]) FROM examples),
hits AS (
  SELECT chunk, out AS id, 0.5 AS gap, h0, h1 FROM targets WHERE u IS NULL
  UNION ALL
  SELECT chunk, id, CASE WHEN id = out THEN 0.0 ELSE -0.5 END, h0, h1
  FROM (SELECT *, spot // step AS part FROM
         (SELECT *, floor(u / 4294967296.0::DOUBLE * total)::BIGINT AS spot FROM targets, noise_size WHERE u IS NOT NULL)) d
  JOIN stretches USING (part) WHERE spot >= lo AND spot < hi),
moved AS (
  SELECT chunk, id, count(*) AS n, sum(0.025 * gap * h0) AS x0, sum(0.025 * gap * h1) AS x1 FROM hits GROUP BY chunk, id)
SELECT v.id, round(coalesce(sum(m.n * m.x0) / sum(m.n), 0.0), 6) AS x0, round(coalesce(sum(m.n * m.x1) / sum(m.n), 0.0), 6) AS x1
FROM vocab v LEFT JOIN moved m USING (id) GROUP BY v.id"""

    chunk_of = f"{hash32(repr('chunk'), '0', 'doc_id', 'line_no', 'sent_no', '(pos // 1000)')} % (SELECT chunks FROM chunks)"
    out["w2v_skipgram_step"] = first_step(f"""
  SELECT doc_id, line_no, sent_no, pos, nth, {chunk_of} AS chunk, context AS out, v0 AS h0, v1 AS h1
  FROM pairs JOIN start ON start.id = center""")
    out["w2v_cbow_step"] = first_step(f"""
  SELECT doc_id, line_no, sent_no, pos, 0 AS nth, {chunk_of} AS chunk, any_value(center) AS out, avg(v0) AS h0, avg(v1) AS h1
  FROM pairs JOIN start ON start.id = context GROUP BY doc_id, line_no, sent_no, pos""")
    out["negative_distribution"] = f"""{tok_w2v}
SELECT id, round(pow(n, 0.75) / (SELECT sum(pow(n, 0.75)) FROM vocab), 9) AS p FROM vocab"""

    # language model
    lm_vocab = with_(tokens(), vocab(LM_MIN_COUNT))
    pair = ", ".join(
        f"round(ln(v{i}.n), 6) AS x{2 * i}, length(v{i}.tok)::DOUBLE AS x{2 * i + 1}" for i in range(CONTEXT)
    )
    joins = " ".join(f"JOIN vocab v{i} ON v{i}.id = w{i}" for i in range(CONTEXT))
    out["lm_embed_lookup"] = f"{ex} SELECT split, ex_id, {pair} FROM examples {joins}"
    def drawn(name: str, *keys: str) -> str:
        return f"({hash32(repr(name), *keys)} / 4294967296.0::DOUBLE - 0.5)"

    inputs = [f"{x}" for i in range(CONTEXT) for x in (f"ln(v{i}.n)", f"length(v{i}.tok)")]
    sums = [
        " + ".join([f"{x} * {drawn('w1', str(i), str(j))}" for i, x in enumerate(inputs)] + [drawn("b1", str(j))])
        for j in range(3)
    ]
    units = ", ".join(f"greatest({x}, 0.0) AS h{j}" for j, x in enumerate(sums))
    # every distinct context once; per context the largest logits and their sum of exponentials
    logit = "h0 * w0 + h1 * w1 + h2 * w2 + b"
    network = f"""hidden AS MATERIALIZED (
  SELECT w0 AS c0, w1 AS c1, w2 AS c2, w3 AS c3, {units}
  FROM (SELECT DISTINCT w0, w1, w2, w3 FROM examples) {joins}),
out_words AS MATERIALIZED (
  SELECT id, {", ".join(f"{drawn('w2', 'id', str(j))} AS w{j}" for j in range(3))}, {drawn("b2", "id", "0")} AS b FROM vocab),
tops AS MATERIALIZED (
  SELECT c0, c1, c2, c3, any_value(h0) AS h0, any_value(h1) AS h1, any_value(h2) AS h2,
         max({logit}) AS top, arg_max(id, {logit}, 3) AS ids, max({logit}, 3) AS logits
  FROM hidden, out_words GROUP BY c0, c1, c2, c3),
softmax AS MATERIALIZED (
  SELECT t.c0, t.c1, t.c2, t.c3, any_value(t.h0) AS h0, any_value(t.h1) AS h1, any_value(t.h2) AS h2,
         any_value(t.top) AS top, any_value(t.ids) AS ids, any_value(t.logits) AS logits, sum(exp({logit} - top)) AS total
  FROM tops t, out_words GROUP BY t.c0, t.c1, t.c2, t.c3)"""
    same = "c0 = w.w0 AND c1 = w.w1 AND c2 = w.w2 AND c3 = w.w3"
    own = logit.replace("w0", "o.w0").replace("w1", "o.w1").replace("w2", "o.w2").replace("+ b", "+ o.b")
    scored = f"""{ex}, {network},
scored AS MATERIALIZED (
  SELECT w.split, w.mb_id, w.ex_id, w.y, ids[1] AS y_hat, exp({own} - top) / total AS p_y
  FROM (SELECT e.*, mb_id FROM batched JOIN examples e USING (split, ex_id)) w
  JOIN softmax ON {same} JOIN out_words o ON o.id = w.y)"""
    out["lm_score"] = f"{scored} SELECT split, ex_id, y, y_hat, round(p_y, 9) AS p_y FROM scored"
    out["l2_norm"] = f"""{lm_vocab}
SELECT round(0.5 * 0.01 * sum(ln(n) ** 2 + length(tok) ** 2), 6) AS penalty FROM vocab"""
    out["lm_cost"] = f"""{scored}
SELECT round(avg(cost), 6) AS cost FROM (SELECT avg(-ln(p_y)) AS cost FROM scored GROUP BY split, mb_id)"""
    out["lm_accuracy"] = f"""{scored}
SELECT split, round(avg(hit), 6) AS accuracy
FROM (SELECT split, avg((y = y_hat)::INTEGER) AS hit FROM scored GROUP BY split, mb_id) GROUP BY split"""
    out["lm_predict_topk"] = f"""{ex}, {network}
SELECT split, ex_id, rank::INTEGER AS rank, ids[rank] AS word_id, round(exp(logits[rank] - top) / total, 9) AS p
FROM (SELECT *, unnest([1, 2, 3]) AS rank FROM examples w JOIN softmax ON {same})"""
    prob, hs, ws = f"exp({logit} - top) / total", ["h0", "h1", "h2"], ["w0", "w1", "w2"]
    w1 = {(i, j): drawn("w1", str(i), str(j)) for i in range(2 * CONTEXT) for j in range(3)}
    moved = ", ".join(
        f"CASE WHEN h{j} > 0 THEN n * s{j} - coalesce(o{j}, 0) ELSE 0 END / N_ AS g{j}" for j in range(3)
    )
    one = "SELECT {layer} AS layer, '{name}' AS name, {row}::INTEGER AS row, {at} AS unit, {old} AS old, {g} AS g FROM {of}".format
    weights = [one(layer=0, name="w", row="id", at=d, old=("ln(n)", "length(tok)::DOUBLE")[d], g=f"coalesce(e{d}, 0)", of="vocab LEFT JOIN lm_words USING (id)") for d in (0, 1)]
    slots = " UNION ALL ".join(
        f"SELECT c{s} AS id, {', '.join(' + '.join(f'g{j} * {w1[2 * s + d, j]}' for j in range(3)) + f' AS e{d}' for d in (0, 1))} FROM lm_back" for s in range(CONTEXT)
    )
    weights += [
        one(layer=1, name="w", row=i, at=j, old=w1[i, j], g=f"(SELECT sum(({x}) * g{j}) FROM lm_inputs)", of="(SELECT 1)")
        for i, x in enumerate(f"x{i}" for i in range(2 * CONTEXT)) for j in range(3)
    ]
    weights += [one(layer=1, name="b", row=0, at=j, old=drawn("b1", str(j)), g=f"(SELECT sum(g{j}) FROM lm_back)", of="(SELECT 1)") for j in range(3)]
    weights += [one(layer=2, name="w", row="id", at=j, old=f"w{j}", g=f"(p{j} - coalesce(y{j}, 0)) / N_", of="lm_out") for j in range(3)]
    weights += [one(layer=2, name="b", row=0, at="id", old="b", g="(p - coalesce(y, 0)) / N_", of="lm_out")]
    context = "c0, c1, c2, c3"
    step = f"""{ex}, {network},
lm_train AS MATERIALIZED (SELECT e.w0 AS c0, e.w1 AS c1, e.w2 AS c2, e.w3 AS c3, e.y FROM batched JOIN examples e USING (split, ex_id) WHERE split = 'train'),
lm_total AS (SELECT count(*)::DOUBLE AS N_ FROM lm_train),
lm_soft AS MATERIALIZED (SELECT * FROM softmax JOIN (SELECT {context}, count(*) AS n FROM lm_train GROUP BY {context}) USING ({context})),
lm_true AS MATERIALIZED (SELECT t.*, h0, h1, h2 FROM (SELECT {context}, y AS id, count(*) AS k FROM lm_train GROUP BY ALL) t JOIN lm_soft USING ({context})),
lm_out AS MATERIALIZED (
  SELECT * FROM (SELECT id, any_value(w0) AS w0, any_value(w1) AS w1, any_value(w2) AS w2, any_value(b) AS b, {", ".join(f"sum(n * {prob} * {h}) AS p{j}" for j, h in enumerate(hs))}, sum(n * {prob}) AS p
                 FROM lm_soft, out_words GROUP BY id)
  LEFT JOIN (SELECT id, {", ".join(f"sum(k * {h}) AS y{j}" for j, h in enumerate(hs))}, sum(k) AS y FROM lm_true GROUP BY id) USING (id), lm_total),
lm_back AS MATERIALIZED (
  SELECT {context}, {moved}
  FROM (SELECT {context}, any_value(n) AS n, {", ".join(f"any_value({h}) AS {h}" for h in hs)}, {", ".join(f"sum({prob} * {w}) AS s{j}" for j, w in enumerate(ws))} FROM lm_soft, out_words GROUP BY {context})
  JOIN (SELECT {context}, {", ".join(f"sum(k * {w}) AS o{j}" for j, w in enumerate(ws))} FROM lm_true JOIN out_words USING (id) GROUP BY {context}) USING ({context}), lm_total),
lm_inputs AS MATERIALIZED (SELECT {", ".join(f"{x} AS x{i}" for i, x in enumerate(inputs))}, g0, g1, g2 FROM lm_back {joins.replace("= w", "= c")}),
lm_words AS (SELECT id, sum(e0) AS e0, sum(e1) AS e1 FROM ({slots}) GROUP BY id),
lm_moves AS ({" UNION ALL ".join(weights)})"""
    out["lm_sgd_step"] = f"{step} SELECT layer, name, row, unit::INTEGER AS unit, round(old - 100.0::DOUBLE * g, 6) + 0.0 AS value FROM lm_moves"
    out["lm_adam_step"] = f"{step} SELECT layer, name, row, unit::INTEGER AS unit, round(old - 0.001::DOUBLE * g / (abs(g) + 1e-8::DOUBLE), 6) + 0.0 AS value FROM lm_moves"
    out["lm_init_from_vectors"] = f"""{lm_vocab}
SELECT 0 AS layer, 'w' AS name, id AS row, 2 AS width, round(ln(n) + length(tok), 6) AS total FROM vocab
UNION ALL SELECT 2, 'w', id, 16, 0.0::DOUBLE FROM vocab
UNION ALL SELECT 2, 'b', 0, count(*)::INTEGER, 0.0::DOUBLE FROM vocab"""
    return out
