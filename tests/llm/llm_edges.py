"""Texts at the edges, shared by the tests."""

LONG = " ".join(f"word{i % 997} Lang" for i in range(30_000)) + " " + "x" * 50_000
EDGES = [(1, "Hello World. It's 12 é ẞ İ ΣΑΣ don't"), (2, None), (3, ""), (4, " \n\t "), (5, LONG), (6, "same text here"),
         (6, "same text here"), (None, "a text without id"), (8, "日本語 漢字 \U0001F468‍\U0001F469 x\x1cy\x00z"), (9, "12 34 !!"),
         (10, "same text here")]

SMALL = "/root/testdata/sf0.001"
