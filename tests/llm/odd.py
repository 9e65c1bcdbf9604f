"""Rows that operators have to cope with, and the operators that give a row for each."""

import public_tokenizers

from soukwise.llm import alignment, bpe, langid, licenses, pii, quality, secret_scan, simhash, spots, tokencount, toxicity

CLASHING = ["id", "fp", "label", "base", "spans", "token", "h", "node", "c0", "_range", "_0", "score", "lang", "c"]
SCHEMA = "doc_id bigint, text string, " + ", ".join(f"`{c}` string" for c in CLASHING)
LONG = ("Der und die das 192.168.0.1 token=abcdefgh12 " * 3000) + "x" * 50_000 + " " * 3000 + "\n" + "\U0001F600é" * 500
TEXTS = [None, "", " ", "\n", "a", "The cat sat on the mat, and the dog saw it.", "The cat sat on the mat, and the dog saw it.",
         LONG, "\u0000 ▁ <s>", "password = hunter2hunter2", "mail me: a.b@c.de or +49 (30) 123-456 789", "日本語 の テキスト"]


def rows():
    found = [(i, t) for i, t in enumerate(TEXTS)] + [(5, TEXTS[5]), (None, "no id at all"), (None, None), (None, None)]
    return [(i, t, *(["x"] * len(CLASHING))) for i, t in found]


def frame(spark, some=None):
    return spark.createDataFrame(rows() if some is None else some, SCHEMA)


def vocabulary():
    return bpe.Vocabulary.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def model():
    return tokencount.Model.load(public_tokenizers.path("piece_bpe_32k.model"))


def tokenizers():
    return alignment.Tokenizers(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"),
                                public_tokenizers.PATTERN)


def _quality(df):
    labels = df.sparkSession.createDataFrame([(i, i % 2) for i in range(12)] + [(5, 0), (None, 1), (3, None), (4, 7)],
                                             "doc_id bigint, quality int")
    return quality.learn(df, labels)


def _toxic():
    return toxicity.fit(["you idiot", "nice day", "stupid idiot", "good day"] * 4, [1, 0, 1, 0] * 4)


EACH = {
    "simhash": lambda df: simhash.near_duplicates(df),
    "secrets": lambda df: secret_scan.secrets(df),
    "bpe": lambda df: bpe.digests(df, vocabulary()),
    "bpe_ids": lambda df: bpe.encode(df, vocabulary()),
    "toxicity": lambda df: toxicity.score(df, _toxic()),
    "licences": lambda df: licenses.licences(df),
    "langid": lambda df: langid.predict(df, langid.fit(df)),
    "spots": lambda df: spots.fingerprints(df),
    "tokens": lambda df: tokencount.token_counts(df, model()),
    "pii": lambda df: pii.personal_data(df),
    "quality": lambda df: quality.score(df, _quality(df)),
    "alignment": lambda df: alignment.alignments(df, tokenizers()),
}
