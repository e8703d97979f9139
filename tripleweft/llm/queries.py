"""One query per operator, each over its whole table, and the pipeline; with SQL where SQL can say the same."""

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from tripleweft.llm.ann import nearest
from tripleweft.llm.bpe import encode_decode
from tripleweft.llm.chat import chat_digests, format_chats, with_probe
from tripleweft.llm.common import table
from tripleweft.llm.cosine_dedup import link_vectors
from tripleweft.llm.minhash import near_duplicates
from tripleweft.llm.mixing import plan_mix
from tripleweft.llm.ngram_lm import score_corpus
from tripleweft.llm.periodic_runs import find_runs, with_planted_runs
from tripleweft.llm.pii import BASE, KINDS, find_pii
from tripleweft.llm.substrings import repeated_passages
from tripleweft.llm.token_counts import count_tokens
from tripleweft.llm.toxicity import score_documents
from tripleweft.llm.variants import count_runs, group_variants

QUERIES, ORACLES = {}, {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_entropy_mix(spark, sf_dir):
    """How often the mix takes each document."""
    return plan_mix(table(spark, sf_dir, "documents"))


@query
def op2_multiprobe_neighbours(spark, sf_dir):
    """Ten nearest vectors of every hundredth one."""
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 100 = 0"))


@query
def op3_toxicity(spark, sf_dir):
    """Toxicity of every document, learnt from labelled rows that are not held out."""
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_bpe(spark, sf_dir):
    """Token ids of every document, and the text they decode to."""
    coded = encode_decode(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return coded.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op5_cosine_links(spark, sf_dir):
    """Near-duplicate vectors."""
    return link_vectors(table(spark, sf_dir, "embeddings"))


@query
def op6_token_counts(spark, sf_dir):
    """Unigram token counts of every document."""
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op7_chat_format(spark, sf_dir):
    """What can be read back from all formatted conversations."""
    return chat_digests(format_chats(with_probe(table(spark, sf_dir, "conversations"))))


@query
def op8_substring_dedup(spark, sf_dir):
    """What is left of every document without passages of 50 words that earlier documents hold."""
    return repeated_passages(table(spark, sf_dir, "documents"))


@query
def op9_minhash_classes(spark, sf_dir):
    """Near-duplicate documents."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def _count(kind):
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@query
def op10_pii(spark, sf_dir):
    """Personal data in every document."""
    found = find_pii(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    return found.select("doc_id", *map(_count, KINDS[:BASE]), F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


@query
def op11_kneser_ney(spark, sf_dir):
    """Probability of every document under a model of six sevenths of them."""
    return score_corpus(table(spark, sf_dir, "documents"))


@query
def op12_spelling_variants(spark, sf_dir):
    """Words that occur often, the words near them, and the spelling they are variants of."""
    return group_variants(count_runs(table(spark, sf_dir, "documents"), 6, 5, slip=199))


@query
def op13_periodic_runs(spark, sf_dir):
    """Periodic runs of every document, and what is left without their repeats."""
    found = find_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("less"), (-r["period"]).alias("period"))))
    return found.withColumn("best", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.less")).alias("start"),
        "best.length",
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query
def pipeline(spark, sf_dir):
    """All stages of the corpus pipeline."""
    return corpus_pipeline.run(spark, sf_dir)


# --- the same results as SQL, where SQL can say them on whole tables ------------------

_WORDS = "regexp_extract_all(coalesce({0}, ''), '[^\\x20\\x09-\\x0D]+')"

#: Smallest node reachable over `links` (a, b: both directions) from each of `nodes` (id).
_REACH = """
    reach(id, root) AS (
      SELECT id, id FROM nodes
      UNION SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.id WHERE reach.root < links.b),
    least AS (SELECT id, min(root) AS component_id FROM reach GROUP BY id)
"""

ORACLES["op5_cosine_links"] = f"""
    WITH RECURSIVE nodes AS (SELECT vec_id AS id FROM embeddings),
    usable AS (
      SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links AS (
      SELECT p.vec_id AS a, q.vec_id AS b FROM usable p JOIN usable q ON p.vec_id <> q.vec_id
      WHERE list_cosine_similarity(p.e, q.e) >= 0.95),
    {_REACH}
    SELECT id AS vec_id, (SELECT count(*) FROM links WHERE links.a = least.id) AS n_links, component_id, id = component_id AS kept FROM least
"""

ORACLES["op7_chat_format"] = r"""
    WITH turns AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
      UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
           CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(length('<|im_start|>') + length(replace(replace(role, '\', '\\'), chr(10), '\n')) + 1
                    + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars
    FROM turns GROUP BY conv_id
"""

ORACLES["op8_substring_dedup"] = f"""
    WITH split AS (SELECT doc_id, {_WORDS.format("text")} AS ws FROM documents),
    windows AS (
      SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS k FROM split, unnest(range(1, len(ws) - 48)) AS u(i)),
    firsts AS (SELECT k, min(doc_id) AS f FROM windows GROUP BY k),
    gone AS (
      SELECT DISTINCT doc_id, i + j AS i FROM windows JOIN firsts USING (k), unnest(range(0, 50)) AS u(j) WHERE f < doc_id),
    placed AS (SELECT doc_id, i, ws[i] AS w FROM split, unnest(range(1, len(ws) + 1)) AS u(i)),
    kept AS (
      SELECT doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY i) AS t FROM placed ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
    SELECT doc_id, len(ws) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
    FROM split LEFT JOIN kept USING (doc_id)
"""

ORACLES["op9_minhash_classes"] = f"""
    WITH RECURSIVE split AS (
      SELECT doc_id, {_WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws FROM documents),
    nodes AS (SELECT doc_id AS id FROM split),
    shingles AS (
      SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
      FROM split, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS u(i) WHERE len(ws) > 0),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    pairs AS (
      SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS common FROM shingles p JOIN shingles q ON p.g = q.g AND p.doc_id <> q.doc_id GROUP BY 1, 2),
    links AS (
      SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 75 * (x.n + y.n - common)),
    {_REACH}
    SELECT id AS doc_id, coalesce(n, 0) AS n_shingles, component_id, id = component_id AS kept FROM least LEFT JOIN sizes ON doc_id = id
"""

# The CRC of each run goes through a table that its polynomial gives; near words share what is left without one letter.
ORACLES["op12_spelling_variants"] = r"""
    WITH RECURSIVE runs AS (
      SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
    counted AS (SELECT doc_id, w, count(*) AS n, hex(CAST(doc_id AS VARCHAR) || ':' || w) AS x FROM runs WHERE length(w) >= 6 GROUP BY doc_id, w),
    crcs AS (
      SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(CAST(i AS BIGINT), range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
    bytes AS (
      SELECT *, list_transform(range(length(x) // 2), lambda i: 16 * (strpos('0123456789ABCDEF', x[2 * i + 1]) - 1) + strpos('0123456789ABCDEF', x[2 * i + 2]) - 1) AS b FROM counted),
    hashed AS (
      SELECT w, n, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), b), lambda c, v: xor(c // 256, t[xor(c, v) % 256 + 1])), 4294967295) AS h FROM bytes, crcs),
    slipped AS (SELECT CASE WHEN h % 199 = 0 THEN w[:h % length(w)] || w[h % length(w) + 2:] ELSE w END AS word, n FROM hashed),
    words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slipped WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
    holes AS (
      SELECT word, n, 0 AS kind, word AS k FROM words
      UNION ALL SELECT word, n, 1, word[:i] || '_' || word[i + 2:] FROM words, unnest(range(length(word))) AS u(i)
      UNION ALL SELECT word, n, 2, word[:i] || word[i + 2:] FROM words, unnest(range(length(word))) AS u(i)),
    near AS (
      SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS m FROM holes a JOIN holes b ON a.k = b.k AND a.kind + b.kind = 2 AND a.word <> b.word),
    forms AS (
      SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * words.n THEN top END AS form, CASE WHEN m >= 5 * words.n THEN m END AS form_n
      FROM words LEFT JOIN (SELECT word, count(*) AS n_near, max(m) AS m, arg_min(other, (-m, other)) AS top FROM near GROUP BY word) USING (word)),
    up AS (SELECT word, word AS at, form FROM forms UNION ALL SELECT up.word, forms.word, forms.form FROM up JOIN forms ON up.form = forms.word)
    SELECT forms.word, n, n_near, forms.form, form_n, up.at AS root FROM forms JOIN up ON up.word = forms.word AND up.form IS NULL
"""

if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
