"""Book references in text: finding them, and speaking them in full. All as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Abbreviations and names of books as they are spoken.
BOOKS = {
    "Gen.": "Genesis", "Ex.": "Exodus", "Exod.": "Exodus", "Lev.": "Leviticus", "Num.": "Numbers", "Deut.": "Deuteronomy", "Josh.": "Joshua", "Judg.": "Judges", "Ruth": "Ruth",
    "1 Sam.": "First Samuel", "2 Sam.": "Second Samuel", "1 Kin.": "First Kings", "2 Kin.": "Second Kings", "1 Kings": "First Kings", "2 Kings": "Second Kings",
    "1 Chron.": "First Chronicles", "2 Chron.": "Second Chronicles", "Ezra": "Ezra", "Neh.": "Nehemiah", "Est.": "Esther", "Esth.": "Esther", "Job": "Job", "Ps.": "Psalms", "Psa.": "Psalms", "Psalm": "Psalm",
    "Prov.": "Proverbs", "Eccl.": "Ecclesiastes", "Eccles.": "Ecclesiastes", "Song": "Song of Solomon", "Sol.": "Song of Solomon", "Isa.": "Isaiah", "Jer.": "Jeremiah", "Lam.": "Lamentations", "Ezek.": "Ezekiel", "Dan.": "Daniel",
    "Hos.": "Hosea", "Joel": "Joel", "Amos": "Amos", "Obad.": "Obadiah", "Jon.": "Jonah", "Jonah": "Jonah", "Mic.": "Micah", "Nah.": "Nahum", "Hab.": "Habakkuk", "Zeph.": "Zephaniah", "Hag.": "Haggai", "Zech.": "Zechariah", "Mal.": "Malachi",
    "Matt.": "Matthew", "Mark": "Mark", "Luke": "Luke", "John": "John", "Acts": "Acts", "Rom.": "Romans", "1 Cor.": "First Corinthians", "2 Cor.": "Second Corinthians", "Gal.": "Galatians", "Eph.": "Ephesians", "Phil.": "Philippians", "Col.": "Colossians",
    "1 Thess.": "First Thessalonians", "2 Thess.": "Second Thessalonians", "1 Tim.": "First Timothy", "2 Tim.": "Second Timothy", "Tit.": "Titus", "Titus": "Titus", "Philem.": "Philemon", "Heb.": "Hebrews", "Jas.": "James", "James": "James",
    "1 Pet.": "First Peter", "2 Pet.": "Second Peter", "1 John": "First John", "2 John": "Second John", "3 John": "Third John", "Jude": "Jude", "Rev.": "Revelation",
    "Genesis": "Genesis", "Exodus": "Exodus", "Leviticus": "Leviticus", "Numbers": "Numbers", "Deuteronomy": "Deuteronomy", "Joshua": "Joshua", "Judges": "Judges", "Nehemiah": "Nehemiah", "Esther": "Esther", "Proverbs": "Proverbs", "Ecclesiastes": "Ecclesiastes",
    "Isaiah": "Isaiah", "Jeremiah": "Jeremiah", "Lamentations": "Lamentations", "Ezekiel": "Ezekiel", "Daniel": "Daniel", "Hosea": "Hosea", "Obadiah": "Obadiah", "Micah": "Micah", "Nahum": "Nahum", "Habakkuk": "Habakkuk", "Zephaniah": "Zephaniah",
    "Haggai": "Haggai", "Zechariah": "Zechariah", "Malachi": "Malachi", "Matthew": "Matthew", "Romans": "Romans", "Galatians": "Galatians", "Ephesians": "Ephesians", "Philippians": "Philippians", "Colossians": "Colossians", "Hebrews": "Hebrews", "Revelation": "Revelation",
}
# Full names that a catalogue reference may start with.
FULL_NAMES = (
    "Genesis", "Exodus", "Leviticus", "Numbers", "Deuteronomy", "Joshua", "Judges", "Ruth", "1 Samuel", "2 Samuel", "1 Kings", "2 Kings", "1 Chronicles", "2 Chronicles", "Ezra", "Nehemiah", "Esther", "Job", "Psalm", "Psalms", "Proverbs", "Ecclesiastes",
    "Song of Solomon", "Isaiah", "Jeremiah", "Lamentations", "Ezekiel", "Daniel", "Hosea", "Joel", "Amos", "Obadiah", "Jonah", "Micah", "Nahum", "Habakkuk", "Zephaniah", "Haggai", "Zechariah", "Malachi", "Matthew", "Mark", "Luke", "John", "Acts", "Romans",
    "1 Corinthians", "2 Corinthians", "Galatians", "Ephesians", "Philippians", "Colossians", "1 Thessalonians", "2 Thessalonians", "1 Timothy", "2 Timothy", "Titus", "Philemon", "Hebrews", "James", "1 Peter", "2 Peter", "1 John", "2 John", "3 John", "Jude", "Revelation",
)
# Abbreviated names that a reference in running text may start with.
SHORT_NAMES = (
    "Gen", "Exod?", "Lev", "Num", "Deut", "Josh", "Judg", "Sam", "Kgs", "Chr", "Neh", "Esth", "Psa?", "Prov", "Eccl", "Isa", "Jer", "Lam", "Ezek", "Dan", "Hos", "Mic", "Nah", "Hab", "Zeph",
    "Hag", "Zech", "Mal", "Matt?", "Mk", "Lk", "Jn", "Rom", "Cor", "Gal", "Eph", "Phil", "Col", "Thess", "Tim", "Heb", "Jas", "Pet", "Rev",
)
DASH = r"\s*[-–]\s*"


def _spoken_pattern(books: dict[str, str]) -> str:
    names = "|".join(re.escape(b) for b in sorted(books, key=len, reverse=True))
    more = rf"(?:\s*,\s*\d+(?:{DASH}\d+)?)*"
    return rf"(?U)(?<!\w)((?:[123]\s)?(?:{names}))\s+(\d+)(?::(\d+)(?:{DASH}(\d+))?({more}))?(?!\w)"


def verse_words(first: Column, last: Column, extra: Column) -> Column:
    """"verse 3", "verses 3 through 5", "verses 3, 7, 9 through 11"; last and extra may be empty."""
    rest = F.transform(F.regexp_extract_all(extra, F.lit(rf"\d+(?:{DASH}\d+)?"), F.lit(0)), lambda x: F.regexp_replace(x, DASH, " through "))
    lead = F.when(last != "", F.concat_ws(" through ", first, last)).otherwise(first)
    return F.concat(F.when((last != "") | (F.size(rest) > 0), F.lit("verses ")).otherwise(F.lit("verse ")), F.array_join(F.concat(F.array(lead), rest), ", "))


def expand_references(text: Column, books: dict[str, str] = BOOKS) -> Column:
    """References as <sub alias="…">; a book that the lexicon lacks stays as it is."""
    pattern = _spoken_pattern(books)
    lexicon = F.create_map(*[F.lit(x) for pair in books.items() for x in pair])
    parts, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def spoken(m: Column) -> Column:
        book = F.try_element_at(lexicon, F.regexp_extract(m, pattern, 1))
        chapter, first = F.regexp_extract(m, pattern, 2), F.regexp_extract(m, pattern, 3)
        verse = F.when(first != "", F.concat(F.lit(", "), verse_words(first, F.regexp_extract(m, pattern, 4), F.regexp_extract(m, pattern, 5)))).otherwise(F.lit(""))
        return F.when(book.isNull(), m).otherwise(F.concat(F.lit('<sub alias="'), book, F.lit(" chapter "), chapter, verse, F.lit('">'), m, F.lit("</sub>")))

    said = F.array_join(F.zip_with(parts, F.transform(found, spoken), lambda p, s: F.concat(F.coalesce(p, F.lit("")), F.coalesce(s, F.lit("")))), "")
    likely = F.regexp_like(text, F.lit(r"(?U)\s\d")) & F.regexp_like(text, F.lit(pattern))  # the first test is cheap
    return F.when(likely, said).otherwise(text)


def first_reference(text: Column, n_lines: int = 16, names: tuple[str, ...] = FULL_NAMES) -> Column:
    """The first catalogue reference in the first lines, or ''. Names compare with case, in the listed order."""
    head = F.slice(F.split(text, "\n", -1), 1, n_lines)
    found = F.transform(head, lambda line: F.regexp_extract(line, rf"(?:{'|'.join(names)})\s+\d+:\d+(?:-\d+)?", 0))
    return F.coalesce(F.get(F.filter(found, lambda r: r != ""), F.lit(0)), F.lit(""))


def references(text: Column, names: tuple[str, ...] = FULL_NAMES, short: tuple[str, ...] = SHORT_NAMES) -> Column:
    """Distinct references in order of appearance, without case and without a word boundary on the left. Full names come before
    short ones, in the listed order; white space may stand or lack after a name's number, before the chapter and around the colon."""
    full = [name.replace("Psalm", "Psalms?").replace("Proverbs", "Proverbs?").replace(" ", r"\s*") for name in names if name != "Psalms"]
    pattern = rf"(?i)(?:{'|'.join((*full, *short))})\s*\d+\s*:\s*\d+(?:\s*[-,]\s*\d+)*"
    found = F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda r: F.regexp_replace(F.btrim(r), r"\s+", " ")))
    # the cheap test first: few texts hold two numbers about a colon
    return F.when(F.regexp_like(text, F.lit(r"\d\s*:\s*\d")), found).when(text.isNotNull(), F.array().cast("array<string>"))


def noted_reference(notes: Column) -> Column:
    """What follows "Scripture:" on the first line that opens with it, or ''."""
    return F.btrim(F.regexp_extract(notes, r"(?m)^[ \t]*Scripture:(.*)$", 1))
