"""Small helpers of the corpus tests."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def word(rng, n=9):
    return "".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, n)))


def prose(rng, n):
    return " ".join(word(rng) for _ in range(n))


def rows_of(df, *drop):
    return sorted((tuple(r) for r in df.drop(*drop).collect()), key=repr)
