"""Small frames with everything that may be odd about a row."""

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "h1 string, size string, class string, label string, start string, text_hash string")
LONG = " ".join(f"word{i % 977} and{i % 31}." for i in range(20_000))
PASSAGE = ("Once the river had gone down they walked along its bank for a while. Nobody said anything "
           "about the bridge that was no longer there. The mill stood where it always had stood, "
           "and its wheel was turning slowly in what was left of the water. They sat down to wait.")
OWN = [
    "A first text with its own words about gardens and rain over the hills of the north country.",
    "Zweitens ein Text mit ganz anderen Woertern ueber Berge und Taeler und die Fluesse darin.",
    "Un troisieme texte avec des mots a lui sur la mer et les bateaux qui rentrent le soir.",
]


def odd_rows():
    """(doc_id, text, lang, source): nulls, blanks, repeated rows, shared ids, a long text."""
    return [
        (1, f"{OWN[0]}\n{PASSAGE}", "en", "a"), (2, f"{OWN[1]}\n{PASSAGE}", "de", "a"),
        (3, OWN[2], "fr", None), (3, OWN[2], "fr", None), (3, f"{OWN[0]} {OWN[1]}", None, "b"),
        (4, None, "en", "b"), (5, "", None, None), (6, " \t\n \x0b\x0c\r", "en", "a"),
        (None, f"{OWN[2]}\n{PASSAGE}", "fr", "b"), (None, None, None, None), (7, LONG, "en", "a"),
        (8, "x", "en", "c"), (9, "ÄÖ ñandú 漢字 🙂 é", "es", "c"), (10, "1 2 3 ... !!", "en", "c"),
    ]


def frame(spark, rows):
    return spark.createDataFrame(
        [(*r, None if r[1] is None else len(r[1]), "x", "y", "z", "l", "s", "t") for r in rows], SCHEMA)


def odd(spark):
    return frame(spark, odd_rows()).repartition(3)


def empty(spark):
    return frame(spark, [])
