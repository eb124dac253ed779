"""Small texts for the tests."""

WORDS = [f"{x}{y}" for x in ("ka", "lo", "mi", "ne", "pu", "ra", "si", "to") for y in ("ban", "der", "fil", "gos", "hum", "jat", "kel", "lim")]


def prose(seed, n=120):
    import random

    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + ("." if k % 9 == 8 else "") for k in range(n))


EDGES = [(1, None), (2, ""), (3, " \n\t "), (None, prose(1)), (None, None), (5, prose(2)), (5, prose(2)), (6, prose(2)),
         (7, "word " * 6000), (8, "é中🙂 <|endoftext|> it's"), (9, "a\n\nb\r\nc")]
