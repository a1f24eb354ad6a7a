"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.llm import conversations, katz, merkle, toxicity
from ledgerline.llm.collocations import collocations
from ledgerline.llm.decontam import decontaminate
from ledgerline.llm.html_crf import extract
from ledgerline.llm.imatch import compare_with_edits
from ledgerline.llm.packing import pack
from ledgerline.llm.pii import find
from ledgerline.llm.quality import classify
from ledgerline.llm.quality_rules import apply_rules
from ledgerline.llm.shared import prepare, table
from ledgerline.llm.simhash import near_duplicates


def op1_decontamination(spark, sf_dir):
    """Benchmark words in every whole document."""
    prepare(spark)
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"]).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def remainder(column, n: int):
    """crc32 of an id's text, modulo ``n``; null for a null id."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(n))


def op2_quality(spark, sf_dir):
    """Quality of every whole text, learned from four fifths of the labels."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(remainder("doc_id", 5) == 0, F.lit(True)))
    return classify(docs, table(spark, sf_dir, "labels").where(remainder("doc_id", 5) != 0), held_out="held_out")


def op3_merkle(spark, sf_dir):
    """Fixity audit of the pages' archives against a replica that is hashed
    from its own bytes: some of its records have their first character
    changed, some archives lost their last record."""
    prepare(spark)
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    hurt = F.when(F.col("page_id") % 97 == 13, F.regexp_replace("html", r"(?s)^.", "#")).otherwise(F.col("html"))
    good, copy = merkle.archives(pages).checkpoint(), merkle.archives(pages, html=hurt).checkpoint()
    last = copy.groupBy("archive", "volume").agg(F.max("offset").alias("offset")).where("archive % 5 = 0")
    return merkle.audit_report(good, copy.join(last, ["archive", "volume", "offset"], "left_anti"))


def op4_html_crf(spark, sf_dir):
    """Main text of every page."""
    prepare(spark)
    return extract(table(spark, sf_dir, "pages"), keep=["page_id", "url"])


def op5_pii(spark, sf_dir):
    """Personal data in every whole text."""
    return find(table(spark, sf_dir, "documents"), keep=["doc_id"]).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


def op6_imatch(spark, sf_dir):
    """Fingerprints of all texts, of their edited texts, and likeness."""
    return compare_with_edits(table(spark, sf_dir, "documents"))


def op7_toxicity(spark, sf_dir):
    """Toxicity of every whole text, learned from two thirds of the labels."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(remainder("doc_id", 3) == 1, F.lit(True)))
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 3) != 1)
    model = toxicity.fit(docs, labels)
    return toxicity.score(docs, model, keep=["doc_id", "held_out"]).select("doc_id", "held_out", "score", "predicted", "tox_matches")


def op8_packing(spark, sf_dir):
    """All documents in sequences of 2048 tokens."""
    prepare(spark)
    return pack(table(spark, sf_dir, "documents"))


def op9_simhash(spark, sf_dir):
    """Near-duplicate groups of all documents."""
    prepare(spark)
    return near_duplicates(table(spark, sf_dir, "documents"))


def op10_katz(spark, sf_dir):
    """Log probability of every whole text, learned from six sevenths."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(remainder("doc_id", 7) == 2, F.lit(True)))
    return katz.score(docs)


def op11_collocations(spark, sf_dir):
    """The best phrases of each language."""
    prepare(spark)
    return collocations(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark, sf_dir):
    """Faults, cheapest repair and its digest for every conversation, after
    the damage that the checksums of its rows deal."""
    prepare(spark)
    rows = table(spark, sf_dir, "conversations")
    return conversations.report(conversations.damage(rows), rows)


def op13_quality_rules(spark, sf_dir):
    """Counts, base rules and the verdict of the threshold table, for every
    whole text."""
    return apply_rules(table(spark, sf_dir, "documents"), keep=["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "broken_rules")


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_quality": op2_quality,
    "op3_merkle": op3_merkle,
    "op4_html_crf": op4_html_crf,
    "op5_pii": op5_pii,
    "op6_imatch": op6_imatch,
    "op7_toxicity": op7_toxicity,
    "op8_packing": op8_packing,
    "op9_simhash": op9_simhash,
    "op10_katz": op10_katz,
    "op11_collocations": op11_collocations,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_quality_rules": op13_quality_rules,
}

_AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), '{u}', '{l}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".replace(
    "{u}", _AZ).replace("{l}", _AZ.lower())

ORACLE_SQL = {
    "op1_decontamination": f"""
        WITH b AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
        g AS (SELECT item, len(w[i:i+9]) AS k, list_aggregate(w[i:i+9], 'string_agg', ' ') AS gram
              FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
        d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
        p AS (SELECT r, k, i, list_aggregate(w[i:i+k-1], 'string_agg', ' ') AS gram
              FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i
                    FROM d, (SELECT DISTINCT k FROM g))),
        h AS (SELECT p.r, p.i, p.k, g.item FROM p JOIN g USING (gram, k)),
        n AS (SELECT r, count(DISTINCT pos) AS n_hit
              FROM (SELECT r, unnest(range(i, i + k)) AS pos FROM h) GROUP BY r),
        m AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items
              FROM h GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN n USING (r) LEFT JOIN m USING (r)""",
    "op11_collocations": r"""
        WITH t AS (SELECT coalesce(lang, 'und') AS lang, string_split_regex(translate(coalesce(text, ''), '{u}', '{l}'), '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
        p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(pieces) AS piece FROM t)),
        g AS (SELECT lang, k, list_aggregate(w[i:i+k-1], 'string_agg', ' ') AS phrase
              FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (VALUES (1), (2), (3)) v(k))),
        c AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
        n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM c WHERE k = 1 GROUP BY lang),
        cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM c WHERE k > 1 AND f >= 10),
        cuts AS (SELECT d.*, list_aggregate(w[1:cut], 'string_agg', ' ') AS p, list_aggregate(w[cut+1:k], 'string_agg', ' ') AS q
                 FROM (SELECT *, unnest(range(1, k)) AS cut FROM cand) d),
        scored AS (SELECT u.lang, u.phrase, u.a, u.cut, x.f AS l, y.f AS r, CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
                   FROM cuts u JOIN c x ON x.lang = u.lang AND x.phrase = u.p JOIN c y ON y.lang = u.lang AND y.phrase = u.q),
        best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
        longer AS (SELECT lang, phrase, max(a) AS most FROM (SELECT lang, a, w[1] || ' ' || w[2] AS phrase FROM cand WHERE k = 3
                   UNION ALL SELECT lang, a, w[2] || ' ' || w[3] FROM cand WHERE k = 3) GROUP BY lang, phrase),
        ranked AS (SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank, s.phrase, a, l, r, n.n, score
                   FROM best s JOIN n ON n.lang = s.lang LEFT JOIN longer o ON o.lang = s.lang AND o.phrase = s.phrase
                   WHERE most IS NULL OR 100 * most < 50 * a)
        SELECT * FROM ranked WHERE rank <= 2000""".replace("{u}", _AZ).replace("{l}", _AZ.lower()),
}

_RECORD = """'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10)
  || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: '
  || strlen({html}) || chr(13) || chr(10) || chr(13) || chr(10) || {html} || chr(13) || chr(10) || chr(13) || chr(10)"""


def _merkle_sql() -> str:
    """The audit over whole trees, compared level by level below nodes that
    differ; plain tables have ids and small archives, so one volume each."""
    parts = ["""p AS (SELECT page_id, url, coalesce(html, '') AS html,
        CASE WHEN page_id % 97 = 13 AND html <> '' THEN '#' || substr(html, 2) ELSE coalesce(html, '') END AS hurt FROM pages)"""]
    for r, html in (("a", "html"), ("copy", "hurt")):
        parts.append(f"""{r} AS (SELECT *, coalesce(sum(length) OVER (PARTITION BY archive ORDER BY record, digest
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS "offset"
            FROM (SELECT CAST(floor(page_id / 64.0) AS BIGINT) AS archive, page_id AS record, sha256({_RECORD.format(html=html)}) AS digest,
                         strlen({_RECORD.format(html=html)}) AS length FROM p))""")
    parts.append("""b AS (SELECT * FROM copy QUALIFY NOT (archive % 5 = 0 AND "offset" = max("offset") OVER (PARTITION BY archive)))""")
    for r in "ab":
        parts.append(f"""{r}0 AS (SELECT archive, CAST("offset" // 65536 AS BIGINT) AS node,
            sha256(string_agg(CAST("offset" AS BIGINT) || ':' || length || ':' || digest, ';' ORDER BY "offset", length, digest)) AS h FROM {r} GROUP BY ALL)""")
        for i in range(1, 5):
            parts.append(f"{r}{i} AS (SELECT archive, node // 16 AS node, sha256(string_agg(node || ':' || h, ';' ORDER BY node)) AS h FROM {r}{i - 1} GROUP BY archive, node // 16)")
    for i in range(4, -1, -1):
        below = "" if i == 4 else f"JOIN d{i + 1} ON d{i + 1}.archive = c.archive AND d{i + 1}.node = c.node // 16 AND d{i + 1}.differs"
        parts.append(f"""d{i} AS (SELECT c.* FROM (SELECT coalesce(a{i}.archive, b{i}.archive) AS archive, coalesce(a{i}.node, b{i}.node) AS node, a{i}.h AS ha, b{i}.h AS hb,
            a{i}.h IS DISTINCT FROM b{i}.h AS differs FROM a{i} FULL JOIN b{i} ON a{i}.archive = b{i}.archive AND a{i}.node = b{i}.node) c {below})""")
    parts.append("""steps AS (SELECT archive, count(*) AS nodes_compared FROM (SELECT archive FROM d4 UNION ALL SELECT archive FROM d3 UNION ALL
            SELECT archive FROM d2 UNION ALL SELECT archive FROM d1 UNION ALL SELECT archive FROM d0) GROUP BY archive),
        damage AS (SELECT a.archive, count(*) AS n_damaged, string_agg(a.record || '@' || CAST(a."offset" AS BIGINT) || '+' || a.length || ':' ||
            CASE WHEN b.digest IS NULL THEN 'missing' ELSE 'altered' END, ',' ORDER BY a."offset") AS damaged
            FROM a LEFT JOIN b ON a.archive = b.archive AND a."offset" = b."offset" WHERE a.digest IS DISTINCT FROM b.digest GROUP BY a.archive)""")
    return "WITH " + ",\n".join(parts) + """
        SELECT d4.archive, CAST(0 AS BIGINT) AS volume, ha AS root_a, hb AS root_b, NOT differs AS same, nodes_compared,
               coalesce(n_damaged, 0) AS n_damaged, coalesce(damaged, '') AS damaged
        FROM d4 JOIN steps USING (archive) LEFT JOIN damage USING (archive)"""


def _repair_sql() -> str:
    """The cheapest edits row by row: for each place in the pattern the least
    'cost:audit' so far (costs padded, so text order is that of the pairs)."""
    def add(x, cost, letters):
        return f"(lpad(CAST(CAST(left({x}, 9) AS BIGINT) + {cost} AS VARCHAR), 9, '0') || ':' || substr({x}, 11) || '{letters}')"

    def row(place, before, initial, roles):
        old = f"least({', '.join(f's{b}' for b in before)})" if before else "NULL"
        more = "CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END"
        moves = [f"CASE WHEN fault NOT IN ('blank', 'duplicate') AND initial = '{initial}' THEN {add(old, more, 'K')} END"]
        if roles:
            moves.append(f"CASE WHEN fault NOT IN ('blank', 'duplicate') THEN {add(old, f'1 + {more}', 'R')} END")
        return f"least({add(f's{place}', 2, 'D')}, {', '.join(moves)}) AS t{place}" if before else f"{add(f's{place}', 2, 'D')} AS t{place}"

    crc = """list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' ||
             coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
             lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END)"""
    return f"""WITH RECURSIVE raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor({crc}, 4294967295) % 20 AS k FROM conversations),
        hurt AS (SELECT conv_id, turn, CASE k WHEN 4 THEN 'user' ELSE role END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                 unnest(range(CASE k WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM raw WHERE k <> 0),
        ranked AS (SELECT *, left(role, 1) AS initial, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
                   row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS again FROM hurt),
        f AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN again > 1 THEN 'duplicate'
                     WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
              lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM ranked),
        step AS (SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, '000000000:' AS s0, CAST(NULL AS VARCHAR) AS s1, '000000005:I' AS s2, '000000010:II' AS s3 FROM f
            UNION ALL SELECT conv_id, i, t0, t1, least(t2, {add('t0', 5, 'I')}, {add('t1', 5, 'I')}, {add('t3', 5, 'I')}),
                least(t3, {add('t2', 5, 'I')}, {add('t0', 10, 'II')}, {add('t1', 10, 'II')})
            FROM (SELECT f.conv_id, f.i, {row(0, [], '', False)}, {row(1, [0], 's', False)}, {row(2, [0, 1, 3], 'u', True)}, {row(3, [2], 'a', True)}
                  FROM step JOIN f ON f.conv_id IS NOT DISTINCT FROM step.conv_id AND f.i = step.i + 1)),
        plan AS (SELECT conv_id, CAST(left(least(s0, s3), 9) AS BIGINT) AS cost, substr(least(s0, s3), 11) AS audit
                 FROM step QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
        edits AS (SELECT conv_id, pos, substr(audit, pos, 1) AS e, length(translate(audit, 'D', '')) AS total
                  FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS pos FROM plan)),
        placed AS (SELECT *, sum(CASE WHEN e <> 'I' THEN 1 ELSE 0 END) OVER w AS r, sum(CASE WHEN e <> 'D' THEN 1 ELSE 0 END) OVER w AS o
                   FROM edits WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
        lines AS (SELECT p.conv_id, string_agg(CASE WHEN e = 'K' THEN f.role WHEN (o - 1 - total % 2) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' ||
                      CASE WHEN e = 'I' THEN '' ELSE f.text END, chr(10) ORDER BY pos) AS body
                  FROM placed p LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.r WHERE e <> 'D' GROUP BY p.conv_id),
        stats AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
                  count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
                  count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id)
        SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
               sha256(coalesce(body, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN stats s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
        LEFT JOIN plan p ON p.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM c.conv_id"""


def oracle_sql() -> dict[str, str]:
    return {**ORACLE_SQL, "op3_merkle": _merkle_sql(), "op12_conversation_repair": _repair_sql()}
