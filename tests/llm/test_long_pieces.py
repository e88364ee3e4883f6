import random

from townlens.llm import token_counts
from townlens.llm.vocab import tokenizer

RNG = random.Random(3)
ALPHABETS = ("a", "abcdefghijklmnopqrstuvwxyz", "é日本語한국🙂ğß", "a'stredlvm!?.", "ȩ́öa!'r", "한가각a", "0123456789abcdef", "ABCİΣÉa9_-/", "aअ्िकाx")
LONG = ["".join(RNG.choices(a, k=260)) for a in ALPHABETS] + ["ab" * 60 + "<|endoftext|>" + "c'" * 70]


def test_budgets_and_prefixes_end_inside_long_pieces(spark):
    """A piece of 201 characters is answered as one of 200 is: by every prefix."""
    library = tokenizer("word_bpe_49k.json")
    texts = [*LONG, *(f"two words {t}  \n{t[::-1]} tail" for t in LONG), "x" * 200, "x" * 201, ""]
    truth = [[len(library.encode(t[:k], add_special_tokens=False).ids) for k in range(len(t) + 1)] for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for limit in (3, 20, 60):
        for r in token_counts.token_counts(df, limit=limit).collect():
            assert r["fit_chars"] == max(k for k, n in enumerate(truth[r["doc_id"]]) if n <= limit), (limit, texts[r["doc_id"]])
    stored = token_counts.written(token_counts.prefix_tables(df), "test-inner")
    for r in stored.collect():
        assert token_counts.counts_of(r["inner"] or r["changes"]).tolist() == truth[r["doc_id"]], texts[r["doc_id"]]
    for r in token_counts.answers(stored, 20, chars=77).collect():
        assert r["first_tokens"] == truth[r["doc_id"]][min(77, len(texts[r["doc_id"]]))]
