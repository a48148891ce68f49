"""Registered queries of the training-data operators: thin forms with fixed result columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlens.llm import (bpe, ctw, decontaminate, fim, importance, langid, lines, merkle, piecetable, sigtree, superkmer,
                            toxicity, warc)
from streamlens.llm.common import fresh_path, held_out


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    import public_tokenizers
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    both = bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"), ids="ids", decoded="decoded")
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a passage like a benchmark item, with the most similar window."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.leaks(_documents(spark, sf_dir), items).drop("row")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as archives in the shared folder and read back; a record that fails its check is an error."""
    path = fresh_path(spark, "warc")
    warc.write_archives(warc.with_originals(spark.read.parquet(f"{sf_dir}/pages.parquet")), path)
    back = warc.read_archives(spark, path, payloads=False)
    lost = F.raise_error(F.concat(F.lit("a record of the archives failed its check: "), F.col("failed_check"))).cast("long")
    page = F.when(F.col("failed_check").isNotNull(), lost).otherwise(F.col("page_id")).alias("page_id")
    return back.select(page, "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labels of two thirds of the ids."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    test = held_out(F.col("doc_id"), 3, 1)
    model = toxicity.fit(docs.where(~test), labels.where(~test))
    return toxicity.score(docs, model).select("doc_id", test.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document that repeat an earlier line, exactly or nearly."""
    return lines.report(_documents(spark, sf_dir).select("doc_id", "text"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by rank-order profiles learned from two thirds of them."""
    docs = _documents(spark, sf_dir).select("doc_id", "text", "lang")
    test = held_out(F.col("doc_id"), 3, 1)
    profiles = langid.learn_profiles(docs.where(~test))
    found = langid.identify(docs.drop("lang"), profiles)
    return found.select("doc_id", test.alias("held_out"), "lang_pred", "score", "distance")


def op6_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document, learned from nine tenths of them."""
    test = held_out(F.col("doc_id"), 10, 0)
    found = ctw.score(_documents(spark, sf_dir), ~test)
    return found.select("doc_id", test.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the words of repeated 20-word windows, as digests."""
    kept = superkmer.remove_repeats(_documents(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked by the Jaccard similarity of their five-word shingles."""
    return sigtree.join(_documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op9_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    return merkle.edited_pairs(_documents(spark, sf_dir))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents drawn towards the distribution of the benchmark texts, by hashed words."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    model = importance.fit(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text"))
    return importance.draw(docs, model).select("doc_id", "n_features", "weight", "score", "rank")


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document under a merge-type piece model, as digests."""
    import public_tokenizers
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    both = piecetable.encode(docs, public_tokenizers.path("piece_bpe_32k.model"), ids="ids", decoded="decoded")
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-the-middle form of every document, and the text rebuilt from it, as digests."""
    made = fim.transform(_documents(spark, sf_dir).select("doc_id", "text"))
    return fim.restore(made).select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                                    F.sha2("restored", 256).alias("restored_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_warc": op2_warc,
    "op3_toxicity": op3_toxicity,
    "op4_line_dedup": op4_line_dedup,
    "op5_language_id": op5_language_id,
    "op6_ctw": op6_ctw,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_merkle": op9_merkle,
    "op10_bpe": op10_bpe,
    "op11_importance": op11_importance,
    "op12_sentencepiece": op12_sentencepiece,
    "op13_fim": op13_fim,
}

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

#: DuckDB SQL of those queries that SQL can express.
ORACLE: dict[str, str] = {
    "op2_warc": """WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS d FROM pages),
x AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 +
    ((((instr('0123456789abcdef', substr(d, (5 * k) // 4 + 1, 1)) - 1) * 16 + instr('0123456789abcdef', substr(d, (5 * k) // 4 + 2, 1)) - 1)
      >> CAST(3 - (5 * k) % 4 AS INTEGER)) & 31), 1)), '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM x""",
    "op7_substring_dedup": f"""WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
win AS (SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d)),
rep AS (SELECT doc_id, s FROM win QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, s) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM rep),
each AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x FROM d),
kept AS (SELECT e.doc_id, string_agg(x, ' ' ORDER BY e.i) AS t, count(*) AS n FROM each e ANTI JOIN gone g ON g.doc_id = e.doc_id AND g.i = e.i GROUP BY e.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id""",
    "op8_jaccard_join": f"""WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, k FROM (
  SELECT doc_id, array_to_string(w[s:s + 4], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS s FROM d WHERE len(w) >= 5)
  UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 4)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
both_ AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.a, both_.b FROM reach JOIN both_ ON both_.a = reach.b)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, r.m AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) r ON r.a = d.doc_id""",
    "op11_importance": r"""WITH RECURSIVE step(b, k, v) AS (SELECT range, 0, range FROM range(256)
  UNION ALL SELECT b, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM step WHERE k < 8),
tab AS (SELECT list(v ORDER BY b) AS t FROM step WHERE k = 8),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
q AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
sw AS (SELECT x, count(*) AS n FROM (SELECT unnest(w) AS x FROM d) GROUP BY x),
tw AS (SELECT x, count(*) AS n FROM (SELECT unnest(w) AS x FROM q) GROUP BY x),
hexed AS (SELECT x, hex(encode(x)) AS h FROM (SELECT x FROM sw UNION SELECT x FROM tw)),
buckets AS (SELECT x, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, len(h) // 2),
  lambda i: ((instr('0123456789ABCDEF', substr(h, CAST(2 * i + 1 AS INTEGER), 1)) - 1) * 16 + instr('0123456789ABCDEF', substr(h, CAST(2 * i + 2 AS INTEGER), 1)) - 1)::BIGINT)),
  lambda c, y: xor(c >> 8, t[CAST(xor(c, y) & 255 AS INTEGER) + 1])), 4294967295) % 10000 AS b FROM hexed, tab),
s AS (SELECT b, sum(n) AS n FROM sw JOIN buckets USING (x) GROUP BY b),
t AS (SELECT b, sum(n) AS n FROM tw JOIN buckets USING (x) GROUP BY b),
tot AS (SELECT (SELECT coalesce(sum(n), 0) FROM sw) AS s_all, (SELECT coalesce(sum(n), 0) FROM tw) AS t_all),
gain AS (SELECT b, CAST(floor(1000 * ln((CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * CAST(s_all + 10000 AS DOUBLE)) / (CAST(coalesce(s.n, 0) + 1 AS DOUBLE) * CAST(t_all + 10000 AS DOUBLE)))) AS BIGINT) AS g
  FROM (SELECT DISTINCT b FROM buckets) LEFT JOIN s USING (b) LEFT JOIN t USING (b), tot),
wt AS (SELECT doc_id, sum(g) AS weight FROM (SELECT doc_id, unnest(w) AS x FROM d) JOIN buckets USING (x) JOIN gain USING (b) GROUP BY doc_id),
sc AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight, CAST(coalesce(weight, 0) AS BIGINT) + CAST(floor(-1000 * ln(-ln(
  (CAST(('0x' || substr(sha256('2024:' || d.doc_id), 1, 8)) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM d LEFT JOIN wt ON wt.doc_id = d.doc_id),
rk AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r FROM sc WHERE n_features >= 20)
SELECT sc.*, CASE WHEN r <= (SELECT count(*) FROM rk) * 10 // 100 THEN r END AS rank FROM sc LEFT JOIN rk USING (doc_id)""",
    "op13_fim": r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
  sha256('42:' || doc_id) AS h FROM documents),
k AS (SELECT *, CAST(len(u) AS BIGINT) AS n, list_transform(range(4), lambda i: CAST(('0x' || substr(h, CAST(8 * i + 1 AS INTEGER), 8)) AS BIGINT)) AS r FROM d),
c AS (SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 50 THEN 'plain' WHEN r[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM k),
x AS (SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM x""",
}
