"""The registered queries over the training-data tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from moodtape.llm import chat_format, exact_dedup, language, licenses, line_dedup, main_text, mixing, near_dedup, pieces, prefix_trie, sql, token_files
from moodtape.llm import vector_codes, vector_tree
from moodtape.llm.common import read_table, tokenizer_path
from moodtape.session import work_path


def op1_minhash_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, d, "documents"), words=4)


def op2_token_files(spark: SparkSession, d: str) -> DataFrame:
    path = work_path(spark, "tokens")
    token_files.write_tokens(read_table(spark, d, "documents"), path, tokenizer_path("word_bpe_49k.json"), end_id=1)
    return token_files.token_report(token_files.read_tokens(spark, path))


def op3_source_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_report(read_table(spark, d, "documents"))


def op4_main_text(spark: SparkSession, d: str) -> DataFrame:
    pages = read_table(spark, d, "pages")
    return main_text.extract(pages, main_text.fit(pages))


def op5_license_scan(spark: SparkSession, d: str) -> DataFrame:
    return licenses.find_licenses(read_table(spark, d, "documents"))


def op6_vector_tree(spark: SparkSession, d: str) -> DataFrame:
    rows = read_table(spark, d, "embeddings")
    return vector_tree.nearest(rows, rows.where("vec_id % 20 = 0"))


def op7_piece_encoding(spark: SparkSession, d: str) -> DataFrame:
    return pieces.encoding_digests(read_table(spark, d, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op8_language_id(spark: SparkSession, d: str) -> DataFrame:
    return language.language_report(read_table(spark, d, "documents"))


def op9_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    return line_dedup.line_report(read_table(spark, d, "documents"))


def op10_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    return exact_dedup.mark_copies(read_table(spark, d, "documents"))


def op11_prefix_trie(spark: SparkSession, d: str) -> DataFrame:
    return prefix_trie.trie_nodes(prefix_trie.branched(prefix_trie.turn_sequences(read_table(spark, d, "conversations"))))


def op12_chat_format(spark: SparkSession, d: str) -> DataFrame:
    says = f"{chat_format.END}{chat_format.START}assistant ok"
    more = spark.createDataFrame([(-1, 0, "user", says), (-1, 1, "assistant", says)], "conv_id long, turn long, role string, text string")
    path = work_path(spark, "chat")
    chat_format.write_formatted(read_table(spark, d, "conversations").select(more.columns).unionByName(more), path)
    return chat_format.format_report(chat_format.read_formatted(spark, path))


def op13_vector_codes(spark: SparkSession, d: str) -> DataFrame:
    return vector_codes.compress(read_table(spark, d, "embeddings"))


def _template_rows() -> str:
    quoted = [text.replace("'", "''") for _, text in licenses.TEMPLATES]
    return ", ".join(f"({k}, '{name}', '{text}')" for k, ((name, _), text) in enumerate(zip(licenses.TEMPLATES, quoted)))


QUERIES = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_token_files": op2_token_files,
    "op3_source_mix": op3_source_mix,
    "op4_main_text": op4_main_text,
    "op5_license_scan": op5_license_scan,
    "op6_vector_tree": op6_vector_tree,
    "op7_piece_encoding": op7_piece_encoding,
    "op8_language_id": op8_language_id,
    "op9_line_dedup": op9_line_dedup,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_chat_format": op12_chat_format,
    "op13_vector_codes": op13_vector_codes,
}

ORACLE = {
    "op3_source_mix": r"""
        WITH sized AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                (('0x' || substr(sha256('mix-1|' || doc_id), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
            FROM documents
        ),
        sources AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                ((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight
            FROM sized GROUP BY source
        ),
        ordered AS (
            SELECT *, 3 * source_size AS cap,
                coalesce(sum(3 * source_size) OVER before, 0)::DOUBLE AS capped, coalesce(sum(weight) OVER before, 0) AS gone,
                sum(source_size) OVER ()::DOUBLE AS total, sum(weight) OVER () AS weights
            FROM sources
            WINDOW before AS (
                ORDER BY 3 * source_size / weight::DOUBLE, encode(source) NULLS LAST
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
            )
        ),
        shared AS (SELECT *, (total - capped) / (weights - gone)::DOUBLE AS share FROM ordered),
        level AS (
            SELECT gone AS settled, share AS water FROM shared WHERE weight * share <= cap ORDER BY gone LIMIT 1
        ),
        aimed AS (
            SELECT source, source_size,
                least(cap::DOUBLE, CASE WHEN gone < settled THEN cap::DOUBLE ELSE weight * water END) AS target
            FROM shared, level
        ),
        parts AS (
            SELECT *, floor(CASE WHEN source_size > 0 THEN least(3.0::DOUBLE, target / source_size) ELSE 0 END)::BIGINT AS copies,
                (CASE WHEN source_size > 0 THEN least(3.0::DOUBLE, target / source_size) ELSE 0 END) AS repeats
            FROM aimed
        ),
        chances AS (SELECT *, repeats - copies AS chance, target - copies * source_size AS lacks FROM parts),
        ranked AS (
            SELECT s.doc_id, s.size, c.*, (s.u / (1 - s.u)) / (c.chance / (1 - c.chance)) AS odds
            FROM sized s JOIN chances c ON s.source IS NOT DISTINCT FROM c.source
        ),
        summed AS (
            SELECT *, odds / (1 + odds) AS pareto, sum(size) OVER (PARTITION BY source ORDER BY odds / (1 + odds), doc_id) AS upto,
                row_number() OVER (PARTITION BY source ORDER BY odds / (1 + odds), doc_id) AS place
            FROM ranked
        ),
        ends AS (
            SELECT source, coalesce(min(place) FILTER (upto >= lacks), max(place)) AS last FROM summed GROUP BY source
        ),
        included AS (
            SELECT s.*, chance > 0 AND (place < last OR place = last AND abs(upto - lacks) <= abs(upto - size - lacks)) AS once_more
            FROM summed s JOIN ends e ON s.source IS NOT DISTINCT FROM e.source
        )
        SELECT doc_id, size, source_size, target, size * (copies + CASE WHEN once_more THEN 1 ELSE 0 END) AS taken FROM included
    """,
    "op5_license_scan": r"""
        WITH templates(template, license, text) AS (VALUES """
    + _template_rows()
    + r"""),
        parts AS (
            SELECT doc_id, unnest(list_distinct(
                string_split(t, chr(10)) || regexp_split_to_array(t, '\n[ \t\r]*\n\s*') || [t])) AS passage
            FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
        ),
        texts AS (
            SELECT row_number() OVER () AS id, doc_id, NULL AS license, passage AS t FROM parts
            UNION ALL SELECT -1 - template, NULL, license, text FROM templates
        ),
        worded AS (
            SELECT id, doc_id, license, string_split(trim(regexp_replace(lower(t), '[^\p{L}\p{N}]+', ' ', 'g')), ' ') AS words
            FROM texts
        ),
        pairs AS (
            SELECT id, doc_id, license, len(words) - 1 AS size, unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS bigram
            FROM worded WHERE len(words) > 1
        ),
        counted AS (SELECT id, doc_id, license, size, bigram, count(*) AS times FROM pairs GROUP BY ALL),
        common AS (
            SELECT p.id, p.doc_id, t.license, t.id AS template, p.size, t.size AS t_size, sum(least(p.times, t.times)) AS common
            FROM counted p JOIN counted t USING (bigram) WHERE p.id > 0 AND t.id < 0 GROUP BY ALL
        ),
        scored AS (SELECT *, 2.0::DOUBLE * common / (size + t_size) AS score FROM common),
        best AS (SELECT id, doc_id, license, max(score) AS score FROM scored WHERE score >= 0.8::DOUBLE GROUP BY ALL)
        SELECT doc_id, license, max(score) AS score, count(*) AS n_passages FROM best GROUP BY doc_id, license
    """,
    "op9_line_dedup": r"""
        WITH texts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        every AS (
            SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM texts
        ),
        keyed AS (
            SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
            FROM every
        ),
        frequent AS (
            SELECT line_key, max(doc_id) AS last_doc FROM keyed WHERE length(line_key) >= 20
            GROUP BY line_key HAVING count(DISTINCT doc_id) >= 3
        ),
        marked AS (
            SELECT k.doc_id, k.pos, k.line, f.line_key IS NOT NULL AND k.doc_id <> f.last_doc AS dropped
            FROM keyed k LEFT JOIN frequent f USING (line_key)
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
    "op10_exact_dedup": r"""
        WITH texts AS (
            SELECT doc_id, length(coalesce(text, '')) AS chars,
                sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents
        ),
        best AS (
            SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id,
                count(*) OVER (PARTITION BY text_sha256) AS group_size
            FROM texts
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM best
    """,
    "op11_prefix_trie": sql.TRIE,
    "op12_chat_format": sql.CHAT,
    "op13_vector_codes": sql.CODES,
}
