import math
import time

from terracask.llm import url_filter as uf

from .conftest import write

PAGES = "page_id bigint, url string, html string"


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:cut], rest[cut:]
    end = min([tail.index(c) for c in "?#" if c in tail] or [len(tail)])
    return host.translate({i: i + 32 for i in range(65, 91)}), tail[:end]


def plain_rule(host, path):
    best = None
    for r in uf.RULES:
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path) and (best is None or len(r.text) > len(best.text)):
            best = r
    return best


URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/es/1", "https://a.org", "https://a.org/", "https://org/x", "https://notorg/x", "http://example.org/en/14", "http://example.org/en/2",
    "http://x.com/fr/1?u=http://y.org/", "http://x.com/de", "http://x.com/de/", "http://com/de/a#b", "ftp://ÄB.com?x/y", "a://b://c/d", "http://h" + "o" * 20_000 + ".net/p", "http://l.net/\nq",
]


def test_query_against_plain_version(spark, tmp_path):
    rows = [(i, u, "x") for i, u in enumerate(URLS)] + [(None, "https://casino-poker.net/x", None), (3, "http://", "y")]
    got = uf.op9_url_filter(spark, write(spark, tmp_path, pages=spark.createDataFrame(rows, PAGES))).collect()
    assert len(got) == len(rows)
    for r in got:
        u = next(u for i, u, _ in rows if i == r["page_id"])
        assert (r["host"], r["path"]) == plain_parts(u)
        rule = plain_rule(r["host"], r["path"])
        assert r["rule"] == (rule.text if rule else None)
        assert r["verdict"] == (rule.verdict if rule else "block" if r["block_probability"] >= 0.5 else "allow")


#: Labelled by hand, none of them in the table that is learnt from.
HELD_OUT = """
block http://royal-poker-casino.com/join
block https://free-slots-jackpot.net/spin
block http://live-betting-odds.biz/football
block https://best-online-casinos.co.uk/bonus
block http://viagra-discount-pharmacy.net/buy
block https://cheap-pills-express.com/order
block http://hot-adult-cams.tv/live
block https://xxx-porn-movies.org/watch
block http://escort-girls-dating.com/book
block https://fast-payday-loan.org/apply
block http://crypto-giveaway-doubler.com/claim
block https://claim-free-prize-winner.info/gift
block http://replica-watches-cheap.net/sale
block https://cracked-games-torrent.com/keygen
block http://warez-full-download.biz/serial
block https://popup-adserver-network.com/banner
block http://click-tracker-ads.net/redirect
block https://spam-bulk-mailer.com/lists
block http://verify-account-login-alert.com/paypal
block https://make-fast-money-online.net/secret
allow https://www.harvestnews.org/village/meeting
allow https://museum.oldharbour.org/exhibits/maps
allow https://docs.streamparser.org/guide
allow https://www.university-press.edu/journal/history
allow https://blog.quietgarden.net/roses
allow https://library.northbridge.gov/opening
allow https://www.wetterbericht.de/vorhersage
allow https://recettes-simples.fr/tarte
allow https://noticias-del-norte.es/economia
allow https://forum.woodenboats.net/thread/varnish
allow https://www.hospital-stann.org/cardiology
allow https://school.riverbend.edu/lessons/geography
allow https://chess.openingtheory.org/endgames
allow https://www.philharmonic.org/concerts
allow https://birds.fieldnotes.org/species/warbler
allow https://research.ocean-institute.edu/currents
allow https://www.mountainhikers.net/trails
allow https://poems.eveninglight.org/sonnets
allow https://www.city-archive.gov/records
allow https://thethirteenth.net/chapter
"""


def test_held_out_accuracy(spark):
    rows = [line.split() for line in HELD_OUT.split("\n") if line]
    assert not {u for _, u in rows} & {u for u, _ in uf.labelled_urls()}
    judged = uf.judge(spark.createDataFrame(rows, "label string, url string"), uf._built_in(spark), rules=()).collect()
    assert sum(r["verdict"] == r["label"] for r in judged) >= 0.9 * len(rows)


def plain_hash(data, seed=42):
    """Murmur3 in 32 bits, signed."""

    def turn(x, n):
        return (x << n | x >> 32 - n) & 0xFFFFFFFF

    h, whole = seed, len(data) & ~3
    for k in [int.from_bytes(data[i : i + 4], "little") for i in range(0, whole, 4)]:
        h = turn(h ^ turn(k * 0xCC9E2D51 & 0xFFFFFFFF, 15) * 0x1B873593 & 0xFFFFFFFF, 13) * 5 + 0xE6546B64 & 0xFFFFFFFF
    if tail := data[whole:]:
        h ^= turn(int.from_bytes(tail, "little") * 0xCC9E2D51 & 0xFFFFFFFF, 15) * 0x1B873593 & 0xFFFFFFFF
    h ^= len(data)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
        h = (h ^ h >> shift) * factor & 0xFFFFFFFF
    return h - (1 << 32) if h >> 31 else h


def test_verdicts_against_brute_force(spark, tmp_path):
    """N-grams, hashes, scores and verdicts anew in plain Python, from the learnt coefficients."""
    model = uf._built_in(spark)
    weights, bias = model.coefficients.toArray(), model.intercept
    rows = [(i, u, "") for i, u in enumerate([*URLS, *(line.split()[1] for line in HELD_OUT.split("\n") if line), "http://a/", "x://casino.é😀.net/ü?x"])]
    got = {r["page_id"]: r for r in uf.op9_url_filter(spark, write(spark, tmp_path, pages=spark.createDataFrame(rows, PAGES))).collect()}
    for i, url, _ in rows:
        host, path = plain_parts(url)
        grams = set()
        for mark, part in (("h:", host), ("p:", path)):
            if part:
                padded = f"^{part}$"
                grams |= {mark + padded[a : a + n] for n in uf.SIZES for a in range(max(len(padded) - n + 1, 1))}
        buckets = {plain_hash(g.encode()) % uf.BUCKETS for g in grams}
        chance = 1 / (1 + math.exp(-(bias + sum(weights[b] for b in buckets))))
        rule = plain_rule(host, path)
        assert abs(got[i]["block_probability"] - chance) < 2e-6
        assert got[i]["verdict"] == (rule.verdict if rule else "block" if chance > 0.5 else "allow")


def test_a_very_long_url(spark):
    long = "http://casino.net/" + "abc/" * 250_000
    start = time.perf_counter()
    row = uf.judge(spark.createDataFrame([(long,)], "url string"), uf._built_in(spark)).first()
    assert len(row["path"]) == 1_000_001 and time.perf_counter() - start < 60


def test_clashing_columns_and_empty_table(spark):
    df = spark.createDataFrame([("http://a.org/", 1, 2, 3, 4, 5)], "url string, host int, path int, rule int, verdict int, features int")
    row = uf.judge(df, uf._built_in(spark)).first()
    assert (row["host"], row["path"], row["rule"], row["verdict"], row["features"]) == (1, 2, 3, 4, 5)
    assert (row["host_"], row["rule_"], row["verdict_"]) == ("a.org", "org/", "allow")
    assert uf.judge(df.limit(0), uf._built_in(spark)).count() == 0
