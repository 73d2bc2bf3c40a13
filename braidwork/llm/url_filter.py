"""URL filters with DataFrame functions only: rules by host and path, then logistic regression on hashed character n-grams.

Host is what follows the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; path what follows it up to `?`, `#` or the end. A rule fits
its host and all subdomains of it where the path starts with the rule's; the longest fitting rule decides. Other urls are scored
by a model of SLOTS weights, trained on the driver from a small labelled table, EPOCHS times over its rows; it is a plain literal when
pages are scored, so scoring is one narrow projection of DataFrame functions. held_out_errors() tells how the model does on labelled urls that it
has not seen; BLOCK_AT is the greatest threshold, in twentieths, that lets through at most a fifth of the unwanted ones among these (47 of 240; it
blocks 91 of 240 wanted ones).

Defined edge cases: null urls and urls without `://` have an empty host and path, fit no rule and get the model's bias (allow); repeated
rows are judged alike; rules of one length are told apart by their text, the greatest wins; urls of any length are one row; an empty table gives no
rows; columns of the caller whose names clash with the results' (u_host, u_path, u_rule, u_verdict, u_score) are replaced, others are
kept unread.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

SLOTS, EPOCHS, RATE, DECAY = 1 << 11, 15, 2.0, 0.9999
#: The model blocks from this chance on.
BLOCK_AT = 0.45
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: The labelled table: invented urls of many forms, with and without scheme, subdomains, ports, files and queries.
UNWANTED = """
http://lucky7-casino-bonus.com/signup?aff=3301
https://www.bigwin-slots.net/free-spins/today.php
http://poker.royalflush-deals.biz/tournament/enter
https://betting-odds24.com/live/football/accumulator
http://sure-bets.tipster-vip.info/telegram
https://jackpotcity-mirror.xyz/en/slots/mega
http://www.blackjack-cheats.org/system-that-works.html
https://roulette-strategy-win.com/buy-now
http://cheapviagra-online.biz/order/50mg
https://rx-discount-pills.com/no-prescription
http://www.buy-cialis-cheap.net/checkout.php?item=22
https://canadian-pharmacy-meds.org/shop/antibiotics
http://fast-weight-loss-pills.info/miracle/before-after
https://keto-gummies-deal.com/free-trial
http://male-enhancement-store.biz/offer
https://xxx-tube-free.com/videos/hot-teens/page/2
http://www.adult-cams-live.net/models/online
https://sexy-singles-nearby.com/chat?ref=mail
http://hardcore-porn-hd.org/watch/83321
https://escort-directory-city.com/london/incall
http://nude-celebs-leaked.net/gallery/17
https://milf-dating-tonight.com/join
http://payday-loan-instant.com/apply?amount=500
https://bad-credit-cash.net/approved
http://www.quick-loans-no-check.biz/form
https://forex-robot-profit.com/autotrade
http://bitcoin-doubler-fast.io/deposit
https://crypto-giveaway-elon.live/claim
http://double-your-eth.xyz/airdrop?wallet=0
https://binary-options-signals.net/vip
http://make-money-from-home-now.info/secret-method
https://get-rich-system.biz/ebook/download
http://www.free-iphone-winner.com/claim/prize.php
https://you-have-won-giftcard.net/survey/step1
http://congratulations-visitor.xyz/reward
https://replica-rolex-watches.biz/submariner/cheap
http://fake-designer-bags.net/louis/outlet
https://cheap-nike-outlet-store.top/sale
http://warez-full-crack.org/photoshop/keygen.zip
https://serial-keys-free.net/windows/activator.exe
http://torrents-movies-hd.to/download/magnet/9912
https://free-mp3-leak.ru/album.rar
http://www.modded-apk-hack.com/unlimited-coins
https://download-driver-updater.info/setup.exe?src=ad
http://your-pc-is-infected.xyz/scan/alert.html
https://secure-login-verify-account.com/paypal/update.php
http://bank-account-suspended.info/confirm
https://seo-backlinks-cheap.com/10000-links
http://guest-post-link-farm.net/buy/dofollow
https://article-spinner-seo.biz/spin
http://buy-instagram-followers.net/5000-likes
https://cheap-traffic-bot.com/adsense
http://ads.clicktrack-pixel.com/imp?id=83&cb=11
https://popunder-network.net/banner/serve.js
http://doorway-pages-keywords.info/cheap-flights-cheap-hotels-cheap-cars
https://psychic-love-spells.net/return-ex
http://herbal-cure-diabetes.biz/doctors-hate-this
https://anti-aging-cream-trial.com/rush-my-order
http://essay-writing-cheap.net/order-essay
https://fake-diploma-online.org/buy-degree
""".split()
WANTED = """
https://www.riverside-school.edu/calendar/2021/autumn-term
http://library.northfield.gov/catalogue/search?author=woolf
https://museum-of-glass.org/exhibitions/current/index.html
http://www.oakdale-council.gov/planning/applications/1842
https://physics.lakeview-university.edu/courses/ph201/notes.pdf
http://journal-of-botany.org/volume/33/issue/2/ferns
https://harbourlights.com/news/2019/07/04/lighthouse-reopens
http://dailycourant.com/politics/budget-debate-continues
https://www.eveningpost.co/sport/cricket/second-test-report
http://weather.coastguard.gov/forecast/shipping
https://kitchen-garden-notes.net/recipes/leek-and-potato-soup
http://www.breadmakers-guild.org/sourdough/starter
https://blog.hillwalker.net/2018/05/three-days-on-the-ridge
http://anna-draws.com/sketchbook/page/4
https://docs.fastqueue.io/guide/installation
http://manual.openplotter.org/chapters/axes.html
https://code.smalltools.dev/parser/issues/58
http://forum.telescope-makers.org/threads/grinding-a-mirror.911
https://lists.kernelhackers.org/archive/2016-March/004512.html
http://wiki.medieval-towns.net/index.php?title=York
https://encyclopedia.seabirds.org/entry/gannet
http://www.stmarys-hospital.org/clinics/eye/visiting-hours
https://health.midshire.gov/vaccination/children
http://train-times.net/stations/ely/departures
https://www.cityferry.com/timetable/winter
http://maps.parkrangers.gov/trails/eagle-peak
https://bookshop-on-the-square.com/new/poetry
http://www.hotel-alpenblick.at/zimmer
https://stadtbibliothek-ulm.de/oeffnungszeiten
http://www.volkshochschule-mitte.de/kurse/sprachen
https://mairie-de-vernon.fr/vie-locale/marche
http://www.boulangerie-du-port.fr/nos-pains
https://lycee-jean-moulin.fr/orientation/terminale
http://ayuntamiento-ronda.es/cultura/agenda
https://www.biblioteca-municipal.es/horarios
http://diario-del-sur.es/2017/11/02/la-cosecha-de-aceituna
https://radio-fonte.it/programmi/mattina
http://orchestra-of-the-north.org/season/tickets
https://www.playhouse-theatre.com/whats-on/hamlet
http://chess.villageclubs.org/results/league-2
https://rowing-association.org/regatta/entries
http://gardenbirds.info/identify/finches
https://oldmaps.archive-county.org/sheet/112
http://parish-records.net/baptisms/1790
https://www.history-of-bridges.com/stone/arches
http://lectures.astronomy-society.org/2020/exoplanets
https://statistics.office-data.gov/tables/population/2011
http://standards-board.org/documents/iso-paper-sizes
https://law-reports.gov/cases/1974/smith-v-jones
http://jobs.townhall.gov/vacancies/gardener
https://www.savings-bank.coop/branches/highstreet
http://post-office.gov/parcels/rates
https://film-quarterly.net/reviews/the-third-man
http://poems-for-children.org/animals/owl
https://mathworkbook.net/fractions/exercise-7
http://learn-french-slowly.com/lessons/12/past-tense
https://vets-in-practice.org/dogs/ticks
http://www.beekeepers-of-kent.org/meetings
https://repair-your-bike.net/brakes/cables
http://knitting-circle.org/patterns/mittens
""".split()



def _spread(urls: list[str]) -> list[list[str]]:
    """Each url as it stands, and below a subdomain with a common last label, which so falls to both kinds alike."""
    out = []
    for k, u in enumerate(urls):
        host, slash, path = u.split("://", 1)[1].partition("/")
        name = host.removeprefix("www.").rpartition(".")[0]
        out.append([u, *(f"http://{sub}{name}.{last}{slash}{path}" for sub, last in (("www.", ("org", "com", "net")[k % 3]), ("", ("com", "net", "org")[k % 3]), (("m.", "blog.", "shop.")[k % 3], ("net", "org", "com")[k % 3])))])
    return out


LABELLED = [(v, y) for y, urls in ((1, UNWANTED), (0, WANTED)) for vs in _spread(urls) for v in vs]


def host_and_path(url: Column | str) -> tuple[Column, Column]:
    url = F.col(url) if isinstance(url, str) else url
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def grams(host: Column, path: Column, slots: int = SLOTS) -> Column:
    """Distinct slots of the 3- and 4-grams of the whole host, each label between two dots, and path."""

    def of(text: Column, n: int, kind: str) -> Column:
        at = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.pmod(F.xxhash64(F.lit(kind), F.substring(text, i, F.lit(n))), F.lit(slots)).cast("int"))

    marked, tail = F.concat(F.lit("."), host, F.lit(".")), F.translate(path, "0123456789", "0000000000")
    return F.array_distinct(F.concat(of(marked, 3, "h3"), of(marked, 4, "h4"), of(tail, 4, "p4")))


def margin(slots: Column, weights: Column) -> Column:
    """Log-odds; the bias is the last weight."""
    total = F.aggregate(slots, F.lit(0.0), lambda a, i: a + F.get(weights, i))
    return total / F.sqrt(F.greatest(F.size(slots), F.lit(1)).cast("double")) + F.get(weights, F.lit(SLOTS))


def train(spark: SparkSession, labelled: list[tuple[str, int]], epochs: int = EPOCHS) -> list[float]:
    """Weights by stochastic gradient steps over the labelled rows, a small table, in order of their hash. A step touches its own slots; the
    decay of all others is kept in one factor."""
    rows = spark.createDataFrame(labelled, "url string, y int").select("y", grams(*host_and_path("url")).alias("x"), F.xxhash64("url").alias("h")).orderBy("h", "y").collect()
    w, scale = [0.0] * (SLOTS + 1), 1.0
    for _ in range(epochs):
        for r in rows:
            root = math.sqrt(max(len(r.x), 1))
            odds = scale * (sum(w[i] for i in r.x) / root + w[SLOTS])
            step = (r.y - 1 / (1 + math.exp(-odds))) * RATE / root
            scale *= DECAY
            for i in [*r.x, SLOTS]:
                w[i] += step / scale
    return [v * scale for v in w]


def held_out_errors(spark: SparkSession, labelled: list[tuple[str, int]] | None = None, folds: int = 4) -> list[tuple[float, int]]:
    """(chance, label) of each labelled url, by a model that was trained without its fold (every folds-th url of each label)."""
    labelled = labelled or LABELLED
    every = len(_spread(UNWANTED[:1])[0]) if labelled is LABELLED else 1  # forms of one url stay together
    fold = {u: i // every % folds for y in (0, 1) for i, u in enumerate(u for u, own in labelled if own == y)}
    out = []
    for k in range(folds):
        weights = F.lit(train(spark, [(u, y) for u, y in labelled if fold[u] != k]))
        rows = spark.createDataFrame([(u, y) for u, y in labelled if fold[u] == k], "url string, y int")
        out += [(r.p, r.y) for r in rows.select("y", (1 / (1 + F.exp(-margin(grams(*host_and_path("url")), weights)))).alias("p")).collect()]
    return out


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, or nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        own, slash, rest = text.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def judged(pages: DataFrame, url_col: str = "url", rules: tuple = RULES, labelled: list[tuple[str, int]] | None = None) -> DataFrame:
    """pages with u_host, u_path, u_rule, u_verdict and u_score, the model's chance that the url is unwanted."""
    labelled = labelled or LABELLED
    weights = F.lit(train(pages.sparkSession, labelled))
    host, path = host_and_path(F.col(url_col).cast("string"))
    out = pages.withColumns({"u_host": host, "u_path": path}).withColumn("u_slots", grams(F.col("u_host"), F.col("u_path")))
    rule, verdict = rule_of(F.col("u_host"), F.col("u_path"), rules)
    out = out.withColumns({"u_rule": rule, "u_by_rule": verdict, "u_score": 1 / (1 + F.exp(-margin(F.col("u_slots"), weights)))})
    return out.withColumn("u_verdict", F.coalesce("u_by_rule", F.when(F.col("u_score") >= BLOCK_AT, "block").otherwise("allow"))).drop("u_slots", "u_by_rule")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = judged(table(spark, sf_dir, "pages").select("page_id", "url"))
    return rows.select("page_id", F.col("u_host").alias("host"), F.col("u_path").alias("path"), F.col("u_rule").alias("rule"), F.col("u_verdict").alias("verdict"), F.round("u_score", 6).alias("score"))
