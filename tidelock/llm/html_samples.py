"""The small labelled table for HTML extraction: pages in fragments, 1 for main text and 0 for the rest.

All texts are invented; what counts is how blocks of either kind are built,
how long they are, what links they hold and what stands around them.
"""

_S = "The river rose over night and the lower road was closed before the market opened."
_L = " ".join([_S, "Three boats were tied to the old wall, and the keeper said that the gate would hold until noon.", "Nobody had seen the water so high since the bridge was built, and most of the shops along it stayed shut."])
_NAV = '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">World news today</a></li><li><a href="/c">Sport</a></li></ul></nav>'
_MENU = '<div id="menu"><ul><li><a href="/a">Home</a></li><li><a href="/b">About</a></li><li><a href="/c">Contact us here</a></li></ul></div>'
_FOOT = "<footer>&copy; 2020 The Gazette &middot; All rights reserved. Printed on the island by the harbour press.</footer>"

#: Pages as lists of (label, html); blocks take the label of the fragment in which their text begins.
PAGES: list[list[tuple[int, str]]] = [
    # an article among menus, adverts and footers, with short and long paragraphs
    [(0, "<html><head><title>High water</title></head><body>" + _NAV), (0, '<div class="ad">Buy two lamps and get a third one free this week only at the shop by the mill.</div>'), (1, f"<article><h1>High water</h1><p>{_L}</p><p>Rain.</p><p>{_S}</p><p>It fell.</p></article>"), (0, _FOOT + "</body></html>")],
    [(0, "<body>" + _NAV + f'<div class="ad">{_S}</div>'), (1, f"<article><h1>Low tide on the shore</h1><p><b>{_S}<br><p>Gone.<p>{_L}<p>Sand.</article>"), (0, "<footer>Contact.</footer>")],
    [(0, f"<body><header><a href='/'>The Gazette</a> <p>{_S}</p></header>"), (1, f"<article><p>{_S}</p><ul><li>Two ropes</li><li>A lamp and some oil for the night</li></ul><p>Then home.</p></article>"), (0, f"<aside><h3>Most read</h3><p>{_S}</p><a href='/x'>More of these</a></aside>" + _FOOT)],
    [(0, f"<body>{_NAV}<div class='cookie-notice'><p>We use cookies to make this site work and to count visits. {_S}</p><button>Accept</button></div>"), (1, f"<article><h2>Ropes</h2><p>{_L}</p>"), (0, f"<div class='share'><a href='/s'>Share this</a></div><div class='ad'>{_S}</div><form><p>Sign up for our letter, it comes once a week.</p><input></form>"), (1, f"<p>{_S}</p><p>So it ends.</p></article>"), (0, f"<section class='comments'><h3>Comments</h3><div class='comment'><p>{_L}</p></div><div class='comment'><p>I agree.</p></div></section>" + _FOOT)],
    [(0, f"<body>{_MENU}<div class='sidebar'><p>{_S}</p></div>"), (1, f"<article><header><h1>Stone</h1></header><p>{_S}</p><blockquote>{_S}</blockquote><p>No.</p></article>"), (0, f"<div id='footer'><p>{_S}</p></div>")],
    # main without article
    [(0, f"<body>{_NAV}"), (1, f"<main><h1>On mills</h1><p>{_L}</p><p>A wheel.</p><h2>Later</h2><p>{_S}</p></main>"), (0, f"<aside><p>{_S}</p></aside>{_FOOT}")],
    [(0, f"<body><header>{_NAV}<p>All the news from the coast, every day of the year since the harbour was dug.</p></header>"), (1, f"<main><p>{_S}</p><p>Yes.</p><table><tr><td>Oats</td><td>Four sacks</td></tr></table></main>"), (0, f"<div class='newsletter'><p>{_S}</p></div>{_FOOT}")],
    [(0, f"<body>{_MENU}"), (1, f"<main><h1>Salt</h1><p>{_S}</p>"), (0, f"<div class='related'><h3>Related</h3><a href='/1'>Salt in winter</a></div><div id='comments'><p>{_S}</p><p>Nice.</p></div>"), (1, f"<p>{_L}</p></main>"), (0, _FOOT)],
    # content by its class
    [(0, f"<body>{_MENU}"), (1, f"<div class='post-content'><h1>Wool</h1><p>{_L}</p><p>Dyed.</p><p>{_S}</p></div>"), (0, f"<div class='widget'><p>{_S}</p></div><div class='footer'>Terms of use and the small print that nobody reads to its end.</div>")],
    [(0, f"<body><div class='header'><p>{_S}</p></div>"), (1, f"<div id='article-body'><p>{_S}</p><p>White.</p><ul><li>Short</li><li>{_S}</li></ul></div>"), (0, f"<div class='sponsored'><p>{_L}</p></div><div id='comments'><p>{_S}</p></div>")],
    # plain pages: only length and links tell
    [(0, "<body><p><a href='/a'>Home</a> | <a href='/b'>Archive</a> | <a href='/c'>Search the site</a></p>"), (1, f"<h1>Letters</h1><p>{_L}</p><p>{_S}</p><p>{_L}</p>"), (0, "<p><a href='/d'>Next page</a></p><p><a href='/e'>Top</a></p>")],
    [(0, "<body><div><a href='/a'>Home</a> <a href='/b'>Shop</a></div>"), (1, f"<div><p>{_S}</p><p>{_L}</p><p>{_S}</p></div>"), (0, "<div><a href='/d'>Imprint</a> <a href='/e'>Privacy</a></div><div>Seen 12 times</div>")],
    [(0, "<body><table><tr><td><a href='/a'>One</a></td><td><a href='/b'>Two</a></td></tr></table>"), (1, f"<div>{_L}</div><div>{_S}</div>"), (0, "<div>Page 3</div><div><a href='/n'>Older</a></div>")],
    # forms, notices and adverts inside of articles
    [(0, f"<body>{_NAV}"), (1, f"<article><h1>Glass</h1><p>{_S}</p>"), (0, f"<aside class='advert'><p>{_L}</p></aside><nav><a href='/p'>Page two</a></nav><footer><p>{_S}</p></footer><form><label>Your name</label><p>{_S}</p></form>"), (1, "<p>Clear.</p></article>"), (0, f"<div role='dialog'><p>{_S}</p></div>{_FOOT}")],
    [(0, f"<body>{_NAV}<div class='banner'>{_S}</div>"), (1, f"<article><p>One.</p><p><a href='/x'>A link that is a paragraph</a></p><p>{_L}</p><h2>Two</h2><p>Three words here.</p></article>"), (0, f"<ul class='comment-list'><li>{_S}</li><li>Good.</li></ul><div class='disqus'>{_S}</div>")],
    # comments that are articles themselves
    [(0, f"<body>{_NAV}"), (1, f"<article><h1>Clay</h1><p>{_L}</p><p>Fire.</p></article>"), (0, f"<section id='comments'><article class='comment'><p>{_L}</p></article><article class='comment'><p>Me too.</p></article></section><div class='popup'>{_S}</div>")],
    # names that hold parts of either kind
    [(0, f"<body class='has-sidebar'>{_MENU}"), (1, f"<div class='post-content has-comments'><h1>Bread</h1><p>{_L}</p><p>Rye.</p></div>"), (0, f"<div class='comment-body'><p>{_L}</p></div><div class='comment-content'><p>Yes.</p></div><div class='footer-text'><p>{_S}</p></div>")],
    [(0, f"<body>{_NAV}<div class='ad-content'><p>{_S}</p></div>"), (1, f"<article><div class='entry-content'><p>{_S}</p><p>Hay.</p>"), (0, f"<div class='ad-text'>{_S}</div>"), (1, f"<p>{_L}</p></div></article>"), (0, f"<div class='sidebar-content'><p>{_L}</p></div><div class='newsletter-body'>{_S}</div>")],
    [(0, f"<body><div id='site-header'>{_S}</div>"), (1, f"<div class='story-body'><p>{_S}</p><p>Ice.</p></div>"), (0, f"<div class='related-story'><p>{_S}</p></div><div class='cookie-main'>{_L}</div>")],
    # what nothing marks, beside what something marks
    [(0, f"<body><div>{_S}</div><p>Seen 12 times.</p>"), (1, f"<article><h1>Peat</h1><p>{_S}</p><p>Cut.</p></article>"), (0, _NAV), (0, f"<div>{_S}</div><p>{_L}</p>")],
    [(0, f"<body><p>{_L}</p>"), (1, f"<article><p>{_L}</p><p><a href='/x'>Source</a></p><ul><li>Dry.</li></ul></article>"), (0, f"<p>{_S}</p><p><a href='/y'>Back to the list</a></p>")],
    [(0, f"<body><div>{_S}</div>"), (1, f"<main><h1>Tar</h1><p>Black.</p><p>{_S}</p><p>Hot.</p></main>"), (0, _NAV), (0, f"<p>{_S}</p>")],
    [(0, f"<body><div>{_L}</div>"), (1, f"<div class='post-content'><p>{_S}</p><p><a href='/x'>The map</a></p><p>Then on.</p></div>"), (0, f"<p>{_S}</p>{_NAV}")],
]
