"""Synthetic pages with known scores."""



def page(*, head="", body=""):
    return f"<!DOCTYPE html><html><head><title>T &amp; t</title><meta name='description' content='D'><link rel=canonical href='/c'>{head}</head><body>{body}</body></html>"


PARA = " ".join(f"{a}{b}" for a in "abcde" for b in ("xa", "yb", "zc", "wd"))  # 20 different words

FULL = page(
    head='<script type="application/ld+json">{"@graph": [{"@type": "Article", "dateModified": "2026-09-10"}, {"@type": ["FAQPage", "BreadcrumbList"]}]}</script><style>p{}</style>',
    body=f"<h1>Top</h1><h2>What is it?</h2><ul><li>one<li>two</ul><p>{PARA}<h3>How much</h3><h3>Why?</h3><table><tr><td>1<td>2.5</tr></table><p>3 of 4, 50% and 7</p>"
    "<a href='https://other.example/x'>o</a><a href='//third.example'>t</a><a href='https://shop.own.example/p'>own</a><a href='/rel'>r</a><a href='http://fourth.example'>f</a><p>a gift for him</p>",
)
POOR = page(body="<h2>Story</h2><p>" + "spam " * 50 + "</p>")
NO_ANSWER = page(body=f"<h2>Why?</h2><h3>Next</h3><p>{PARA}</p><h4>Frequently asked things</h4>")
SHORT_ANSWER = page(body="<h2>Why?</h2><p>too short</p>" + f"<h2>How?</h2><p>{PARA}</p>")
BAD_JSON = page(head='<script type="application/ld+json">{oops</script><script type="application/ld+json">[{"@type": "Article", "datePublished": "2025-01-01T00:00:00Z"}]</script>', body=f"<p>{PARA}</p>")
