"""IBANs inside running text."""

from scorecast.llm import pii

DE, GB, SPACED = "DE89370400440532013000", "GB82WEST12345698765432", "GB82 WEST 1234 5698 7654 32"
CASES = [
    (f"Pay {DE} Please", [DE]), (f"Pay {DE} 12 May", [DE]), (f"{DE} I paid", [DE]), (f"{DE} BIC COBADEFF", [DE]),
    (f"{SPACED} NOW OR LATER", [SPACED]), (f"{SPACED} 5 EUR, {DE}.", [SPACED, DE]), (f"{DE} {GB}", [DE, GB]),
    (f"{SPACED} {SPACED} {DE} {DE}", [SPACED, SPACED, DE, DE]), (f"AB12 CD34 {DE} X", [DE]),
    (f"😀 {DE} Zahlung\n{GB}x {GB}", [DE, GB]), (f"{DE}X {DE}9 x{DE}", []), ("NO9386011117947 A", ["NO9386011117947"]),
    ("MT84MALT011000012345MTLCAST001S 2020", ["MT84MALT011000012345MTLCAST001S"]), ("DE89370400440532013001 Please", []),
    ("AB12 " * 300, None), (DE, [DE]),
]


def test_ibans_before_other_words(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "doc_id long, text string")
    for r in pii.find_pii(df).collect():
        text, want = CASES[r["doc_id"]]
        spans = [(s["start"], s["end"]) for s in r["pii"] if s["kind"] == "iban"]
        if want is not None:
            assert [text[a:b] for a, b in spans] == want, text
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
