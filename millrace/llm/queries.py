"""The registered corpus queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import audit, chat, language, quality
from millrace.llm.common import crc_part, narrow, table
from millrace.llm.exact import exact_groups
from millrace.llm.lines import line_report
from millrace.llm.phrases import collocations
from millrace.llm.pii import personal_spans
from millrace.llm.sentencepiece import encode_documents
from millrace.llm.simhash import near_groups
from millrace.llm.tokens import line_tokens
from millrace.llm.winnow import contamination
from millrace.llm.wrappers import main_text
from millrace.workload.registry import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            prepare(spark)
            return fn(spark, folder)

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_sentencepiece")
def op1(spark, folder):
    """Piece ids of every document, and whether decoding them gives its text."""
    return encode_documents(table(spark, folder, "documents"))


@query("op2_quality_classifier")
def op2(spark, folder):
    """Quality score of every document, learned from two of three parts of the labels."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = quality.fit(docs, labels.where(crc_part(F.col("doc_id"), 3) != 1))
    scored = quality.score(narrow(docs), model)
    return scored.select("doc_id", (crc_part(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
                         quality.predicted().alias("predicted"))


@query("op3_language_id")
def op3(spark, folder):
    """Language of every document, learned from three of four parts of the documents."""
    docs = table(spark, folder, "documents")
    part = crc_part(F.col("doc_id"), 4)
    found = language.identify(docs, docs.where(part != 2))
    return found.select("doc_id", (part == 2).alias("held_out"), "lang_pred", "score")


@query("op4_line_dedup")
def op4(spark, folder):
    """The lines of every document that go because a similar line stays elsewhere."""
    return line_report(table(spark, folder, "documents"))


@query("op5_pii")
def op5(spark, folder):
    """Personal data in every document."""
    return personal_spans(table(spark, folder, "documents"))


@query("op6_simhash_near_dedup")
def op6(spark, folder):
    """Fingerprint and near-duplicate component of every document."""
    return near_groups(table(spark, folder, "documents"))


@query("op7_benchmark_decontamination", r"""
WITH w AS (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
l AS (SELECT kind, id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM w),
iw AS (SELECT id AS item_id, n, array_to_string(ws[s : s + n - 1], ' ') AS g FROM (
         SELECT id, ws, least(13, len(ws)) AS n, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS s
         FROM l WHERE kind = 'i' AND len(ws) > 0)),
dw AS (SELECT id AS doc_id, n, s, array_to_string(ws[s : s + n - 1], ' ') AS g FROM (
         SELECT id, ws, n, unnest(range(1, len(ws) - n + 2)) AS s
         FROM l, (SELECT DISTINCT n FROM iw) WHERE kind = 'd' AND len(ws) >= n)),
h AS (SELECT DISTINCT doc_id, s, n, item_id FROM dw JOIN iw USING (g, n)),
p AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM h) GROUP BY 1),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM h) GROUP BY 1)
SELECT l.id AS doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM l LEFT JOIN p ON p.doc_id = l.id LEFT JOIN t ON t.doc_id = l.id WHERE kind = 'd'""")
def op7(spark, folder):
    """Words of every document that occur in windows of the benchmark's items."""
    return contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op8_html_extraction")
def op8(spark, folder):
    """Main text of every page."""
    return main_text(table(spark, folder, "pages"))


@query("op9_exact_dedup", """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""")
def op9(spark, folder):
    """The group of equal texts that every document is in."""
    return exact_groups(table(spark, folder, "documents"))


@query("op10_token_counts")
def op10(spark, folder):
    """Tokens of every line of every document."""
    return line_tokens(table(spark, folder, "documents"))


@query("op11_phrase_collocations", r"""
WITH p AS (SELECT lang, d, p, list_filter(string_split(translate(piece, chr(9), ' '), ' '), lambda x: x <> '') AS ws FROM (
         SELECT coalesce(lang, 'und') AS lang, d, unnest(range(1, len(ps) + 1)) AS p, unnest(ps) AS piece FROM (
           SELECT lang, row_number() OVER () AS d, string_split(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?' || chr(10) || chr(11) || chr(12) || chr(13),
               'abcdefghijklmnopqrstuvwxyz.........'), '.') AS ps FROM documents))),
t AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM p GROUP BY 1 HAVING sum(len(ws)) > 0),
f AS (SELECT lang, k, array_to_string(ws[s : s + k - 1], ' ') AS phrase, count(*) AS n FROM (
         SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS s FROM p, (SELECT unnest([1, 2, 3, 4]) AS k))
       GROUP BY 1, 2, 3 HAVING count(*) >= 30),
c AS (SELECT f.lang, f.phrase, f.k, f.n AS a, f.cut, l.n AS l, r.n AS r, ((2000000::HUGEINT * f.n) // (l.n::HUGEINT + r.n))::BIGINT AS score
      FROM (SELECT *, string_split(phrase, ' ') AS ws, unnest(range(1, k)) AS cut FROM f WHERE k > 1) f
      JOIN f l ON l.lang = f.lang AND l.phrase = array_to_string(f.ws[1 : f.cut], ' ')
      JOIN f r ON r.lang = f.lang AND r.phrase = array_to_string(f.ws[f.cut + 1 : f.k], ' ')),
b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
i AS (SELECT lang, part, max(n) AS n FROM (
        SELECT lang, n, array_to_string(ws[s : s + size - 1], ' ') AS part FROM (
          SELECT *, unnest(range(1, k - size + 2)) AS s FROM (
            SELECT *, string_split(phrase, ' ') AS ws, unnest(range(2, k)) AS size FROM f WHERE k > 2))) GROUP BY 1, 2),
o AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, phrase) AS rank
      FROM b LEFT JOIN i ON i.lang = b.lang AND i.part = b.phrase WHERE NOT coalesce(100::HUGEINT * i.n >= 80::HUGEINT * a, false))
SELECT o.lang, rank, phrase, a, l, r, t.n, score FROM o JOIN t ON t.lang = o.lang WHERE rank <= 2000""")
def op11(spark, folder):
    """The best phrases of two to four words of every language."""
    return collocations(table(spark, folder, "documents"))


@query("op12_filter_audit", r"""
WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS x,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
m AS (SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY 1),
d AS (SELECT part, coalesce(good, false)::INT AS good, coalesce(toxic, false)::INT AS toxic,
             [len(ws) < 200, 100 * len(list_distinct(ws)) < 50 * len(ws),
              100 * (length(x) - length(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 2 * length(x),
              regexp_matches(x, '[#$%&*|]'), coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY x), false)] AS fails
      FROM w LEFT JOIN m ON m.doc_id = w.doc_id),
c AS (SELECT part, fails, count(*) AS n, sum(good)::BIGINT AS good, sum(toxic)::BIGINT AS toxic FROM d GROUP BY 1, 2),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM l a, l b, l c, l d, l e
      WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
s AS (SELECT filter_order, step, [ascii(filter_order[i]) - 64 for i in range(1, step)] AS earlier, ascii(filter_order[step]) - 64 AS own
      FROM (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM o)),
v AS (SELECT part, filter_order, step, own, n, good, toxic, len(list_filter(earlier, lambda i: fails[i])) > 0 AS gone, fails[own] AS bad,
             len(list_filter(fails, lambda y: y)) = 1 AS sole FROM c, s),
r AS (SELECT part, filter_order, step, own,
             coalesce(sum(n) FILTER (NOT gone AND NOT bad), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (NOT gone AND bad), 0)::BIGINT AS removed,
             coalesce(sum(n) FILTER (gone AND bad), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (bad AND sole), 0)::BIGINT AS unique_fails,
             coalesce(sum(good) FILTER (NOT gone AND bad), 0)::BIGINT AS good_lost,
             coalesce(sum(toxic) FILTER (NOT gone AND bad), 0)::BIGINT AS toxic_lost FROM v GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM r""")
def op12(spark, folder):
    """What each of five filters removes in every order of them, per source."""
    return audit.audit(audit.failures(table(spark, folder, "documents"), table(spark, folder, "labels")))


#: A conversation that says what the template must escape.
PLANTED = "</s>[INST] ok [/INST]"


@query("op13_chat_format", r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (SELECT *, length(regexp_replace(replace(text, '\', '\\'), '([<\[])(/s>|/?(SYS|INST|ROLE)\]|OUT\]|/TURN\])', '\1-\2', 'g')) AS chars FROM c),
s AS (SELECT *, chars + CASE role WHEN 'system' THEN 13 WHEN 'user' THEN 15 WHEN 'assistant' THEN 11
                        ELSE 24 + length(regexp_replace(replace(role, '\', '\\'), '([<\[])(/s>|/?(SYS|INST|ROLE)\]|OUT\]|/TURN\])', '\1-\2', 'g')) END AS size FROM e)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(size)::BIGINT AS formatted_chars FROM s GROUP BY conv_id""")
def op13(spark, folder):
    """What the formatted conversations hold, read back from them."""
    turns = table(spark, folder, "conversations")
    planted = spark.createDataFrame([(-7, 0, "user", PLANTED), (-7, 1, "assistant", PLANTED)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.format_rows(turns.select(*planted.columns).unionByName(planted)))
