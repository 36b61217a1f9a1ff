"""Default lexicons of speech markup; callers may pass others, as tuples or as tables (see rows_of)."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Fixed values: (name, sound, whether case matters).
PRONUNCIATIONS = (
    ("Job", "dʒoʊb", True),
    ("Naomi", "neɪˈoʊ.mi", False),
    ("Habakkuk", "həˈbæk.ək", False),
    ("Nahum", "ˈneɪ.həm", False),
    ("Malachi", "ˈmæl.ə.kaɪ", False),
    ("Nehemiah", "ˌniː.əˈmaɪ.ə", False),
    ("Deuteronomy", "ˌdjuː.təˈrɒn.ə.mi", False),
    ("Ecclesiastes", "ɪˌkliː.ziˈæs.tiːz", False),
    ("Laodicea", "ˌleɪ.ɒd.ɪˈsiː.ə", False),
    ("Gethsemane", "ɡɛθˈsɛm.ə.ni", False),
    ("Calvary", "ˈkæl.və.ri", False),
    ("Pharisee", "ˈfær.ɪ.siː", False),
    ("Pharisees", "ˈfær.ɪ.siːz", False),
    ("Sadducees", "ˈsæd.juː.siːz", False),
    ("Hezekiah", "ˌhɛz.ɪˈkaɪ.ə", False),
    ("Josiah", "dʒoʊˈsaɪ.ə", False),
    ("Elijah", "ɪˈlaɪ.dʒə", False),
    ("Elisha", "ɪˈlaɪ.ʃə", False),
    ("Isaiah", "aɪˈzeɪ.ə", False),
    ("Jeremiah", "ˌdʒɛr.ɪˈmaɪ.ə", False),
    ("Ezekiel", "ɪˈziː.ki.əl", False),
    ("Obadiah", "ˌoʊ.bəˈdaɪ.ə", False),
    ("Zephaniah", "ˌzɛf.əˈnaɪ.ə", False),
    ("Zechariah", "ˌzɛk.əˈraɪ.ə", False),
    ("Haggai", "ˈhæɡ.aɪ", False),
    ("Micah", "ˈmaɪ.kə", False),
    ("Hosea", "hoʊˈzeɪ.ə", False),
    ("Levi", "ˈliː.vaɪ", False),
    ("Levite", "ˈliː.vaɪt", False),
    ("Levites", "ˈliː.vaɪts", False),
    ("Leviticus", "lɪˈvɪt.ɪ.kəs", False),
    ("Sinai", "ˈsaɪ.naɪ", False),
    ("Horeb", "ˈhɔː.rɛb", False),
    ("Canaan", "ˈkeɪ.nən", False),
    ("Canaanite", "ˈkeɪ.nə.naɪt", False),
    ("Bethlehem", "ˈbɛθ.lɪ.hɛm", False),
    ("Nazareth", "ˈnæz.ə.rɛθ", False),
    ("Galilee", "ˈɡæl.ɪ.liː", False),
    ("Capernaum", "kəˈpɜːr.neɪ.əm", False),
    ("Corinth", "ˈkɒr.ɪnθ", False),
    ("Corinthians", "kɒˈrɪn.θi.ənz", False),
    ("Ephesus", "ˈɛf.ɪ.səs", False),
    ("Ephesians", "ɪˈfiː.ʒənz", False),
    ("Galatians", "ɡəˈleɪ.ʃənz", False),
    ("Philippians", "fɪˈlɪp.i.ənz", False),
    ("Colossians", "kəˈlɒʃ.ənz", False),
    ("Thessalonians", "ˌθɛs.əˈloʊ.ni.ənz", False),
    ("Philemon", "fɪˈliː.mən", False),
    ("Titus", "ˈtaɪ.təs", False),
    ("Hebrews", "ˈhiː.bruːz", False),
    ("Nicodemus", "ˌnɪk.əˈdiː.məs", False),
    ("Lazarus", "ˈlæz.ə.rəs", False),
    ("Barabbas", "bəˈræb.əs", False),
    ("Pontius", "ˈpɒn.ʃəs", False),
    ("Pilate", "ˈpaɪ.lət", False),
    ("Pharaoh", "ˈfɛr.oʊ", False),
    ("Moses", "ˈmoʊ.zɪz", False),
    ("Aaron", "ˈɛr.ən", False),
    ("Abraham", "ˈeɪ.brə.hæm", False),
    ("Isaac", "ˈaɪ.zək", False),
    ("Jacob", "ˈdʒeɪ.kəb", False),
    ("Esau", "ˈiː.sɔː", False),
    ("Boaz", "ˈboʊ.æz", False),
    ("Rahab", "ˈreɪ.hæb", False),
    ("Samson", "ˈsæm.sən", False),
    ("Delilah", "dɪˈlaɪ.lə", False),
    ("Goliath", "ɡəˈlaɪ.əθ", False),
    ("Absalom", "ˈæb.sə.ləm", False),
    ("Bathsheba", "bæθˈʃiː.bə", False),
    ("Melchizedek", "mɛlˈkɪz.ɪ.dɛk", False),
    ("Nebuchadnezzar", "ˌnɛb.jʊ.kədˈnɛz.ər", False),
    ("Belshazzar", "bɛlˈʃæz.ər", False),
    ("Cyrus", "ˈsaɪ.rəs", False),
    ("Mordecai", "ˈmɔːr.dɪ.kaɪ", False),
    ("Esther", "ˈɛs.tər", False),
    ("Jehoshaphat", "dʒɪˈhɒʃ.ə.fæt", False),
    ("Rehoboam", "ˌriː.əˈboʊ.əm", False),
    ("Jeroboam", "ˌdʒɛr.əˈboʊ.əm", False),
    ("Manasseh", "məˈnæs.ə", False),
    ("Ananias", "ˌæn.əˈnaɪ.əs", False),
    ("Sapphira", "səˈfaɪ.rə", False),
    ("Barnabas", "ˈbɑːr.nə.bəs", False),
    ("Apollos", "əˈpɒl.oʊs", False),
    ("Aquila", "ˈæk.wɪ.lə", False),
    ("Priscilla", "prɪˈsɪl.ə", False),
    ("Gamaliel", "ɡəˈmeɪ.li.əl", False),
    ("Beelzebub", "biˈɛl.zɪ.bʌb", False),
    ("Armageddon", "ˌɑːr.məˈɡɛd.ən", False),
    ("Maranatha", "ˌmær.əˈnæθ.ə", False),
    ("Hallelujah", "ˌhæl.ɪˈluː.jə", False),
    ("Selah", "ˈsiː.lə", False),
    ("Jehovah", "dʒɪˈhoʊ.və", False),
    ("Yahweh", "ˈjɑː.weɪ", False),
    ("Arminian", "ɑːrˈmɪn.i.ən", False),
    ("Arminianism", "ɑːrˈmɪn.i.ən.ɪz.əm", False),
    ("Calvinism", "ˈkæl.vɪn.ɪz.əm", False),
    ("Calvinist", "ˈkæl.vɪn.ɪst", False),
    ("Pelagian", "pɪˈleɪ.dʒi.ən", False),
    ("Socinian", "soʊˈsɪn.i.ən", False),
    ("Antinomian", "ˌæn.tɪˈnoʊ.mi.ən", False),
)
# Words in capitals that stay so.
KEEP_UPPER = ("LORD", "GOD", "JEHOVAH", "CHRIST", "JESUS", "HOLY", "KING", "AMEN", "HALLELUJAH", "SELAH", "I", "II", "III", "IV", "V")


def rows_of(table: DataFrame, most: int = 10_000) -> tuple[tuple, ...]:
    """The rows of a lexicon table as tuples for a column expression; a lexicon of more than `most` rows is an error."""
    rows = table.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a lexicon of over {most} rows")
    return tuple(tuple(r) for r in rows)
