"""Documents that operators must not trip over."""

import random


def nasty_texts():
    rng = random.Random(3)
    long = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(9000))
    return [(1, "one two three four five six seven"), (2, None), (3, ""), (4, " \t\n "), (5, long), (6, "x" * 70_000), (None, "a text without an id"),
            (7, "One two three four five six seven"), (8, "one two three four five six seven"), (8, "one two three four five six seven"),
            (9, "É́ ΑΣ ß İ 中文 😀 <|endoftext|> it's"), (10, long + " end"), (None, None), (11, "two words")]
