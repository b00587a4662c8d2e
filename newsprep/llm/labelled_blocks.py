"""The small labelled table that the page classifier learns from.

Invented pages, a line for each piece of markup. A line starts with + if its text belongs
to the article, with - if it does not, with = if it has none. A number in braces stands for
so many words. Lengths are varied when the table is laid out, so that no one number decides.
"""

from __future__ import annotations

PAGES = [
    # A page with the usual elements.
    """
=<body><header>
-<div class="logo"><a href="/">{2}</a></div>
-<p>{4}</p>
=</header><nav><ul>
-<li><a href="/a">{1}</a></li>
-<li><a href="/b">{2}</a></li>
-<li><a href="/c">{1}</a></li>
=</ul></nav>
-<div class="ad">{9}</div>
=<article>
+<h1>{9}</h1>
+<p>{30}</p>
+<p>{70}</p>
+<p>{2}</p>
+<h2>{4}</h2>
+<p>{1}</p>
+<p>{55} <a href="/x">{3}</a> {20}</p>
=<ul>
+<li>{7}</li>
+<li>{12}</li>
=</ul>
+<blockquote>{18}</blockquote>
+<p>{25}</p>
+<p>{6}</p>
=</article><footer>
-<p>&copy; {8}</p>
-<ul><li><a href="/p">{2}</a></li></ul>
=</footer></body>""",
    # Nothing but div, without names.
    """
=<body><div>
-<div><a href="/">{1}</a> <a href="/1">{1}</a> <a href="/2">{2}</a></div>
-<div>{3}</div>
=<form>
-<p>{6}</p>
-<button>{1}</button>
=</form></div><div>
+<h1>{8}</h1>
+<p>{45}</p>
+<p>{60}</p>
+<p>{9}</p>
+<p>{80} <a href="/s">{2}</a> {11}</p>
+<h3>{4}</h3>
+<p>{34}</p>
+<p>{50}</p>
=</div><div>
-<div><a href="/r1">{6}</a></div>
-<div><a href="/r2">{7}</a></div>
-<div><a href="/r3">{5}</a></div>
=</div><div>
-<p>&copy; {4} <a href="/t">{2}</a></p>
=</div></body>""",
    # Named containers, a sidebar, a notice, comments.
    """
=<body><div class="cookie-notice">
-<p>{28} <a href="/privacy">{2}</a></p>
-<button>{2}</button>
=</div><div id="masthead">
-<p>{5}</p>
=</div><div class="content post-body">
+<h1>{7}</h1>
-<p class="byline">{5}</p>
+<p>{52}</p>
+<p>{38}</p>
-<div class="share-links"><a href="/s">{1}</a><a href="/u">{1}</a></div>
+<p>{64}</p>
-<div class="advertisement"><p>{14}</p></div>
+<p>{41}</p>
+<p>{3}</p>
=</div><div id="sidebar">
-<h3>{2}</h3>
-<p>{24}</p>
-<ul><li><a href="/q">{5}</a></li><li><a href="/w">{6}</a></li></ul>
=</div><div id="comments">
-<h3>{2}</h3>
-<div class="comment"><p>{33}</p></div>
-<div class="comment"><p>{12}</p></div>
-<div class="comment"><p>{58}</p></div>
=</div><div class="footer">
-<p>{15}</p>
=</div></body>""",
    # Things that do not belong, within the article.
    """
=<body><nav>
-<a href="/a">{1}</a> <a href="/b">{1}</a>
=</nav><main><article><header>
+<h1>{10}</h1>
=</header>
+<p>{47}</p>
=<aside>
-<h4>{3}</h4>
-<p>{26}</p>
=</aside>
+<p>{35}</p>
=<form>
-<p>{11}</p>
-<label>{2}</label><button>{1}</button>
=</form>
+<p>{8}</p>
=<figure>
+<figcaption>{13}</figcaption>
=</figure>
+<p>{29}</p>
=<footer>
-<p>{12}</p>
=</footer></article><section class="comments">
-<h2>Comments</h2>
=<article class="comment">
-<p>{40}</p>
=</article><article class="comment">
-<p>{5}</p>
=</article></section></main>
-<div>{16}</div>
=</body>""",
    # A whole page within one form; tables.
    """
=<body><form action="/"><table><tr>
-<td><a href="/1">{1}</a></td><td><a href="/2">{1}</a></td><td><a href="/3">{2}</a></td>
=</tr></table><table><tr>
-<td>{2}</td>
=<td>
+<h2>{6}</h2>
+<p>{66}</p>
+<p>{43}</p>
+<p>{57}</p>
+<p>{11}</p>
+<p>{39}</p>
=</td></tr></table>
-<input type="text"><button>{1}</button>
-<p><a href="/c">{2}</a> {3} <a href="/d">{2}</a></p>
=</form></body>""",
    # A list of links only.
    """
=<body>
-<h1>{3}</h1>
=<ul>
-<li><a href="/1">{6}</a></li>
-<li><a href="/2">{8}</a></li>
-<li><a href="/3">{5}</a> {2}</li>
-<li><a href="/4">{9}</a></li>
=</ul>
-<p>&copy; {3}</p>
=</body>""",
    # A short article between much else.
    """
=<body><div class="nav"><ul>
-<li><a href="/1">{1}</a></li>
-<li><a href="/2">{1}</a></li>
=</ul></div>
-<div class="banner">{7}</div>
-<div class="newsletter signup"><p>{19}</p></div>
=<main>
+<h1>{5}</h1>
+<p>{14}</p>
+<p>{4}</p>
=</main><section class="related">
-<h2>Related</h2>
-<p><a href="/r">{6}</a> {15}</p>
-<p><a href="/r">{5}</a> {21}</p>
=</section><div role="contentinfo">
-<p>{18}</p>
=</div></body>""",
    # Plain text without names, with comments under a heading.
    """
=<body>
-<p><a href="/">{1}</a> | <a href="/1">{2}</a></p>
+<h1>{6}</h1>
+<p>{75}</p>
+<p>{28}</p>
+<p>{5}</p>
+<p>{90}</p>
-<h3>3 comments</h3>
-<p>{16}</p>
-<p>{31}</p>
-<h3>Related</h3>
-<p><a href="/r">{7}</a></p>
=</body>""",
    # Notices before and after, nothing but paragraphs in the article.
    """
=<body><div role="alert">
-<p>{22}</p>
=</div><div class="page"><div class="breadcrumbs">
-<a href="/">{1}</a> / <a href="/1">{1}</a> / {4}
=</div><article>
+<p>{20}</p>
+<p>{33}</p>
+<p>{7}</p>
+<div>{25}</div>
+<pre>{30}</pre>
+<p><a href="/k">{4}</a></p>
+<p>{12}</p>
=</article>
-<p>{13}</p>
-<p>{5}</p>
=</div><footer>
-{9}
=</footer></body>""",
    # An article by its classes, the rest by none.
    """
=<body><div>
-<span><a href="/">{2}</a></span>
-<p>{6}</p>
=</div><div class="article-content">
+<h1>{11}</h1>
+<div>{48}</div>
+<div>{37}</div>
+<div>{6}</div>
+<ol><li>{10}</li><li>{3}</li></ol>
+<div>{22}</div>
=</div><div>
-<p>{7}</p>
-<p><a href="/z">{3}</a></p>
=</div></body>""",
    # Links within the text, short last paragraphs before a list of links.
    """
=<body><article>
+<h1>{4}</h1>
+<p>{8} <a href="/1">{2}</a> {6}</p>
+<p><a href="/2">{3}</a> {9} <a href="/3">{2}</a></p>
+<p>{24}</p>
+<p>{1}</p>
+<p>{4}</p>
=</article><nav>
-<a href="/p">{2}</a>
-<a href="/n">{2}</a>
=</nav><footer>
-<a href="/i">{1}</a> <a href="/j">{1}</a>
=</footer></body>""",
    """
=<body>
-<table><tr><td><a href="/1">{1}</a></td><td><a href="/2">{2}</a></td></tr></table>
+<h2>{5}</h2>
+<p>{40} <a href="/a">{4}</a> {12}</p>
+<p>{22} <a href="/b">{6}</a></p>
+<p>{30}</p>
+<ul><li>{14}</li><li>{9}</li><li>{12} <a href="/c">{2}</a></li></ul>
+<p>{17}</p>
-<div><a href="/x">{3}</a></div>
-<div><a href="/y">{4}</a></div>
-<div>{5} <a href="/z">{2}</a></div>
=</body>""",
    # A heading right after the menu, short paragraphs.
    """
=<body class="no-sidebar"><div class="menu">
-<a href="/1">{1}</a> <a href="/2">{1}</a>
=</div><div class="story">
+<h1>{6}</h1>
+<p>{9}</p>
+<p>{22}</p>
+<p>{3}</p>
+<p>{14}</p>
=</div><div>
-<ul><li><a href="/1">{4}</a></li><li><a href="/2">{4}</a></li></ul>
=</div></body>""",
    """
=<body><p>
-<a href="/1">{2}</a></p>
+<h1>{5}</h1>
+<p>{16}</p>
+<p>{21}</p>
+<h2>{3}</h2>
+<p>{13}</p>
+<p>{44}</p>
-<p><a href="/2">{1}</a> <a href="/3">{1}</a></p>
-<p>{5}</p>
=</body>""",
    # Pages that end with the article, one of them cut off.
    """
=<body><nav>
-<a href="/1">{1}</a>
=</nav><article>
+<h1>{7}</h1>
+<p>{1}</p>
+<p>{19}</p>
+<p><a href="/1">{2}</a></p>
+<p>{2}</p>
+<p>{1}</p>
=</article></body>""",
    """
=<body>
+<h1>{6}</h1>
+<p>{26}</p>
+<p>{31}</p>
+<p>{15}</p>""",
]

#: Every page is laid out with its lengths multiplied by each of these.
SCALES = (0.4, 0.7, 1.0, 1.5, 2.5)
