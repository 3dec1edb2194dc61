"""The labelled table that the tagger of personal data learns from.

Written by hand: each form of personal data stands in each sentence, and so does each number or
name that only looks like one. The digits are examples; the tagger sees shapes.
"""

from __future__ import annotations

# Forms by kind.
FORMS = {
    "phone": (
        "(212) 555-9876", "(415)555-2671", "1 (415) 555-2671", "(030) 901820 55", "212-555-0142", "1-800-555-0199",
        "010-1234-5678", "212.555.0142", "030.901820.55", "0049 30 1234567", "00 44 20 7946 0018", "0033 1 70189900",
        "020 7946 0018", "06 12 34 56 78", "030 12345678", "0171 5551234", "030/12345678", "089/123456-78",
        "0221 / 4710 8150", "030-90182055", "98765 43210 11", "212 555 0142", "+1 212 555 9876", "+49 (30) 901820", "+442079460018",
    ),
    "card": (
        "4111.1111.1111.1111", "5500.0000.0000.0004", "3400.000000.00009", "4111 - 1111 - 1111 - 1111",
        "6011 - 0000 - 0000 - 0004", "4012  8888  8888  1881", "3056.930902.5904", "4111 1111 1111 1111", "4111-1111-1111-1111", "4012888888881881",
    ),
    "email": (
        "anna@münchen.de", "info@café.fr", "l.meyer@bücher.example", "anna(at)example.com", "a.b[at]mail.example.org",
        "anna [at] example.com", "anna (at) example (dot) com", "info [at] example [dot] org", "sales{at}example.net",
        "kim(at)example(dot)com", "anna@example.com", "j.doe+x@mail.example.org",
    ),
    "ip": ("192.168.0[.]1", "8[.]8[.]8[.]8", "10[.]0[.]0[.]254", "203[.]0[.]113[.]77", "203.0.113.7", "10.1.20.254"),
}
# Forms after a word that tells what they are.
CUED = {
    "phone": ("tel 2125550142", "phone: 2125550142", "fax 03090182055", "call 01715551234", "mobile: 07911123456", "telefon 03012345678"),
}
# What only looks like personal data.
UNLIKE = (
    "2024-01-15 10:30:00", "2024-01-15 2024-02-29", "12.05.2024 - 13.05.2024", "15/01/2024 16/01/2024", "20240115103000",
    "978-3-16-148410-0", "isbn 0-306-40615-2", "isbn: 978 0 306 40615 7", "isbn 9780306406157", "1.234.567.890", "0.1234567890",
    "3.14159265358", "100 200 300 400", "1 2 3 4 5 6 7 8 9 10", "1000 2000 3000", "12 345 678 901", "1990 1991 1992", "1914-1918 1939-1945",
    "2125550142", "order 1234567890", "invoice 2024-000123-45", "iban DE89 3704 0044 0532 0130 00", "tracking 9400 1000 0000 0000 0000 00",
    "id 4111111111111112", "ref 00123456789", "serial 123-456-789-000", "version 10.0.19045.3803", "1.2.3.4.5.6.7.8.9", "12/34/56/78/90/12",
    "(1999) 123-145 2001", "pp. 1234-1256 1999", "52.520008 13.404954", "123456789012345678901234", "9f99a2c46965bb42334432917e2a1a93",
    "key=83b8a6c644842984c9", "react@latest", "@home", "icon@2x.png", "5@4.99", "git@", "#include", "x[.]y", "f(at)", "arr[at]", "look (at) this", "see [at] once",
    "word [dot] word", "10[.]5", "plain words", "room 12", "24.12.", "99 %", "1st", "A4", "(see 5)", "€ 1.234,56",
)
# Sentences around them.
SENTENCES = (
    "{}", "{} .", "please write {} today", "the number is {}, thanks", "{} was given (twice)", "it said {} and more words",
    "see: {}; then go", "from 3 people {} came 7 times", "Anna {} Berlin", "das ist {} und mehr",
)


def marked_lines(
    forms: dict[str, tuple[str, ...]] = FORMS, cued: dict[str, tuple[str, ...]] = CUED, unlike: tuple[str, ...] = UNLIKE
) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Lines with the spans of personal data in them."""
    out = []
    for sentence in SENTENCES:
        before = sentence.index("{}")
        for kind, texts in forms.items():
            out += [(sentence.format(t), [(kind, before, before + len(t))]) for t in texts]
        for kind, texts in cued.items():
            out += [(sentence.format(t), [(kind, before + t.index(" ") + 1, before + len(t))]) for t in texts]
        out += [(sentence.format(t), []) for t in unlike]
    return out
