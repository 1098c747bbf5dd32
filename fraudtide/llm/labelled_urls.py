"""The labelled URL table of the URL filter: names that tell what a site is for, on reserved domains."""

from __future__ import annotations

BLOCKED = """
casino-royale online-casino lucky-casino mega-slots slots-winner jackpot-city poker-room texas-poker roulette-live
blackjack-bonus sports-betting bet-now-online free-spins bingo-bonus gambling-tips lottery-winners win-big-money
pills-online cheap-viagra discount-meds pharmacy-no-rx buy-cialis weight-loss-pills cheap-drugs-online
xxx-videos adult-cams adult-dating hot-sex-chat porn-tube nude-girls escort-service erotic-stories live-sex
ads-server click-track adtracker track-pixel banner-ads popup-ads ad-farm link-farm spam-links spam-mailer
seo-backlinks traffic-farm click-farm free-gift-cards free-iphone-winner cheap-replica fake-watches
payday-loans easy-credit-cash get-rich-quick crypto-doubler free-followers cracked-software warez-downloads
""".split()

ALLOWED = """
city-library national-museum river-station county-hospital open-university school-reports science-journal
garden-notes bread-recipes travel-stories mountain-weather daily-news evening-post local-history maps
street-photos music-theory chess-club film-reviews theatre parish-council farmers-market bicycle-repair
python-lessons code-review compiler-notes database-internals statistics physics-lectures chemistry-lab
translation-forum language-exchange nation-archive education health-institute nutrition children-books
another-blog thoughts-on-things the-weather-station whether-and-where entertainment-tonight authors-corner
northern-lights southern-herald western-tribune eastern-chronicle thermometer thursday-reading father-and-son
motherhood other-voices together gathering weatherman leather-workshop heather-and-thistle anthropology
conference-papers research-notes documentation reference manual standards wiki encyclopedia dictionary
astronomy geology botany zoology architecture engineering railway harbour airport forest lake island
painting sculpture pottery knitting sewing cooking baking fishing hiking sailing climbing running swimming
""".split()

# Where a page lies says little, so both labels have the same places.
DOMAINS = ("example.com", "example.net", "example.org")
PREFIXES = ("www.", "", "m.", "blog.", "")
PATHS = ("/en/{}", "/de/{}.html", "/fr/{}/", "/es/{}", "/", "/article/{}", "/en/{}/")


def _placed(names: list[str], label: int) -> list[tuple[str, int]]:
    return [
        (f"https://{PREFIXES[i % 5]}{name}.{DOMAINS[i % 3]}{PATHS[i % 7].format(37 * i + 5)}", label)
        for i, name in enumerate(names)
    ]


LABELLED = _placed(BLOCKED, 1) + _placed(ALLOWED, 0)
