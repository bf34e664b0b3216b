"""Labelled training pages: ``data-main="1"`` marks the root of main content, ``data-main="0"`` what is none inside it."""

# Written for training, in the layouts that pages commonly have.
_PROSE = (
    "The river rose slowly through the night, and by morning the lower fields were under water. Farmers moved their animals to "
    "the hill, where the old barn still stood.",
    "Nobody had expected the bridge to hold, yet it did. Two engineers walked across it at noon and declared it safe for carts.",
    "In the town hall people argued about the dam until late. The vote was close, but in the end the plan was accepted.",
    "Short note.",
)


def _page(body: str) -> str:
    return f'<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>River</title></head><body>{body}</body></html>'


_NAV = '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li><li><a href="/c">Sport</a></li></ul></nav>'
_DIVNAV = '<div class="menu"><ul><li><a href="/a">Home</a></li><li><a href="/b">About us</a></li></ul></div>'
_HEADER = '<header><a href="/">The River Post</a><p>All the news of the valley</p></header>'
_FOOTER = "<footer>&copy; The River Post &middot; The river rose slowly. All rights reserved.</footer>"
_DIVFOOT = '<div id="footer"><p>Copyright The River Post. Contact the editors by post.</p></div>'
_AD = '<div class="ad">Buy better boots today. The old barn sells them.</div>'
_AD2 = '<div class="advert banner sponsored"><p>Boots that last. Order now and save.</p></div>'
_SIDE = '<aside><h3>Related</h3><ul><li><a href="/x">Older floods</a></li><li><a href="/y">Bridges</a></li></ul></aside>'
_DIVSIDE = '<div class="sidebar widget related"><h4>Popular</h4><ul><li><a href="/x">Dams</a></li></ul><p>Most read this week by our readers.</p></div>'
_COOKIE = '<div class="cookie notice consent"><p>We use cookies to improve this site. By reading on you agree.</p></div>'
_FORM = '<form action="/s"><label>Search the archive</label><p>Subscribe to our letter.</p></form>'
_P = "".join(f"<p>{p}</p>" for p in _PROSE)
_RICH = (f"<h1>Flood in the valley</h1><p><b>{_PROSE[0]}</b><br>{_PROSE[3]}</p><h2>The bridge</h2><p>{_PROSE[1]} <a href='/d'>More here</a>.</p>"
         f"<blockquote><p>{_PROSE[2]}</p></blockquote><ul><li>One barn was lost.</li><li>Two carts were saved.</li></ul>"
         "<table><tr><th>Day</th><td>Level of the river</td></tr></table><pre>level = 4</pre><figure><figcaption>The bridge at noon.</figcaption></figure>"
         f"<div><p>{_PROSE[1]}</p><p>{_PROSE[3]}</p></div>")
_COMMENTS = ('<div class="comments" data-main="0"><h3>Comments</h3><div class="comment" data-main="0"><p>I saw the bridge myself and it was '
             'a wonder. Nobody believed it.</p></div></div>')
_SECTION_COMMENTS = '<section id="comments"><h2>Reader comments</h2><p>The vote was a mistake, as all of us know by now.</p></section>'
_INNER_AD = '<div class="ad" data-main="0">Boots for every flood.</div>'
_SHARE = '<div class="share social" data-main="0"><a href="/f">Share</a> <a href="/t">Post</a></div>'
_PROMO = '<aside data-main="0"><p>Read also about older floods in the valley.</p></aside>'
_INNER_NAV = '<nav data-main="0"><a href="/p1">1</a> <a href="/p2">2</a></nav>'
_INNER_FORM = '<form data-main="0"><p>Write to the editors.</p></form>'
_HEAD = f'<header data-main="1"><h1>Flood in the valley</h1><p>{_PROSE[3]}</p></header>'

PAGES = [
    _page(f'{_NAV}{_AD}<article data-main="1"><h1>Flood in the valley</h1>{_P}</article>{_FOOTER}'),
    _page(f'{_NAV}{_AD}<article data-main="1">{_RICH}</article>{_FOOTER}'),
    _page(f'{_NAV}{_AD}<article data-main="1"><h1>Flood</h1><p>{_PROSE[3]}</p></article>{_FOOTER}'),
    _page(f'{_HEADER}{_NAV}<main data-main="1"><article>{_RICH}{_PROMO}{_COMMENTS}</article></main>{_SIDE}{_FOOTER}'),
    _page(f'{_COOKIE}{_HEADER}{_DIVNAV}<div id="content" data-main="1">{_RICH}{_INNER_AD}{_P}{_SHARE}</div>{_DIVSIDE}{_DIVFOOT}'),
    _page(f'{_HEADER}{_NAV}<div class="wrapper"><div class="main content" data-main="1">{_P}{_INNER_FORM}</div>{_DIVSIDE}</div>{_FOOTER}'),
    _page(f'{_DIVNAV}{_AD2}<div class="post entry" data-main="1"><h2>Flood</h2>{_P}{_COMMENTS}</div>{_FORM}{_DIVFOOT}'),
    _page(f'{_NAV}<article data-main="1">{_HEAD}{_RICH}{_INNER_NAV}</article>{_SECTION_COMMENTS}{_SIDE}{_FOOTER}'),
    _page(f'{_NAV}<section class="story article" data-main="1">{_RICH}</section>{_FORM}{_COOKIE}{_FOOTER}'),
    _page(f'{_COOKIE}{_NAV}{_AD}<main data-main="1">{_P}<section>{_P}</section><div><p>{_PROSE[1]}</p></div></main>{_FOOTER}'),
    _page(f'{_NAV}<article data-main="1"><h1>A</h1><div>{_P}</div><section><h2>B</h2><ol><li>{_PROSE[2]}</li></ol></section>{_INNER_AD}</article>{_AD}{_FOOTER}'),
    _page(f'{_NAV}<main data-main="1">{_P}</main><section class="comments"><h3>Comments</h3><p>{_PROSE[1]}</p></section>{_FOOTER}'),
    _page(f'{_HEADER}<article data-main="1">{_RICH}</article><div id="comments"><div class="comment"><p>{_PROSE[2]}</p></div></div>{_FOOTER}'),
    _page(f'{_NAV}<article data-main="1">{_P}<section class="comments" data-main="0"><p>{_PROSE[0]}</p></section></article>{_FOOTER}'),
]
