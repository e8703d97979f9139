"""From raw documents to token ids: toxicity, near-duplicates, personal data, mixture, encoding."""

import public_tokenizers

from tripleweft.llm.bpe import encode_decode
from tripleweft.llm.minhash import keep_one_of_each
from tripleweft.llm.mixing import mix
from tripleweft.llm.pii import mask_pii
from tripleweft.llm.toxicity import drop_toxic
from tripleweft.scratch import write_and_read


def toxicity(spark, docs, sf_dir):
    """Rows that are scored as toxic go; the score is learnt from the labels of `sf_dir`."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark, docs, sf_dir):
    """Of each group of near-duplicates the document with the smallest doc_id stays."""
    return keep_one_of_each(docs)


def personal_data(spark, docs, sf_dir):
    """Personal data is masked in place."""
    return mask_pii(docs)


def mixture(spark, docs, sf_dir):
    """Each row as often as the mix takes it, at the weights and the share of the operator's defaults."""
    return mix(docs)


def encoding(spark, docs, sf_dir):
    """All columns, the token ids, and the text they decode to."""
    return encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("minhash_near_dedup", near_dedup),
    ("pii", personal_data),
    ("source_mixing", mixture),
    ("bpe_encoding", encoding),
]

# Learnt scores, similarity classes and token ids are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The stages one after the other over `documents`, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = write_and_read(docs, f"pipeline-{name}")
    return docs
