"""Small pages labelled by hand, which teach the page model layouts that a crawl may hold few of.

What lies inside an element with ``data-main`` is main text, but for what lies inside ``data-off``.
"""

PAGES = (
    # A blog post in divs, with a notice, a share bar, a form and reader comments.
    """<html><body><div id="top" class="site-header"><a href="/">Home</a> <a href="/about">About</a></div>
<div class="cookie-notice">We use cookies to improve this site. By reading on you accept our policy.</div>
<div class="wrapper"><div class="post-content" data-main="1"><h1>A walk along the river</h1>
<p>We set out early in the morning, before the fog had lifted. The path was wet, and nobody spoke much.</p>
<p>By noon the sun was out. We ate by the old mill.</p><p>Rain.</p>
<div class="share-bar" data-off="1"><a href="#">Share</a> <a href="#">Tweet</a></div>
<blockquote>Nothing is softer than water, and nothing is stronger.</blockquote>
<ul><li>Bring good shoes.</li><li>Bring a map of the lower valley.</li></ul></div>
<div id="comments"><h3>Comments</h3><div class="comment"><p>Great post, I walked there last year and loved every minute of it.</p></div>
<div class="comment"><p>Thanks for sharing.</p></div></div>
<form action="/reply"><label>Your comment</label><textarea></textarea><button>Send</button></form></div>
<div class="footer">Copyright 2020. All rights reserved. <a href="/terms">Terms</a></div></body></html>""",
    # A news page with semantic elements, an advert between paragraphs and related links.
    """<html><body><header><h2>The Daily Paper</h2><p>News for everyone, every day.</p><nav><ul><li><a href="/a">World</a></li>
<li><a href="/b">Sport</a></li><li><a href="/c">Culture</a></li></ul></nav></header>
<main data-main="1"><article><h1>Council votes on the new bridge</h1><p>The council voted on Monday to build a second bridge, ending ten years of debate.</p>
<div class="advert" data-off="1"><p>Buy two, get one free. Only this week at your local store.</p></div>
<h2>What comes next</h2><p>Work starts in spring, the mayor said. It may take three years.</p><table><tr><td>Cost</td><td>40 million</td></tr></table>
<form data-off="1"><p>Want more of this? Leave your address, please.</p><input></form><figure><figcaption>The site of the bridge, seen from the north bank.</figcaption></figure><pre>open 09:00
close 17:00</pre>
<aside class="related" data-off="1"><h3>Related</h3><ul><li><a href="/1">Older bridges of the town</a></li></ul></aside></article></main>
<aside><h3>Most read</h3><ol><li><a href="/2">Ten places to see before summer</a></li><li><a href="/3">Weather</a></li></ol>
<p>Sign up for our newsletter and never miss a story again.</p></aside>
<footer><p>About us. Contact. Imprint. All material is protected.</p></footer></body></html>""",
    # Comments that are articles themselves, a sidebar of sections, a banner with prose.
    """<html><body><nav><a href="/">Start</a> <a href="/all">All</a></nav><div class="banner">Sale ends today! Order now and save on everything in the shop.</div>
<div id="content"><article class="entry" data-main="1"><h1>Bread in one hour</h1><p>Mix flour, water and salt. Let it stand for ten minutes, then knead it well.</p>
<section><h2>Baking</h2><p>Bake it hot, at first with steam.</p><p>It is done when it sounds hollow.</p></section>
<form data-off="1"><p>Get a new loaf by mail, each Friday. No spam, we promise.</p><input><button>Yes please</button></form></article>
<section class="comments"><h2>3 comments</h2><article class="comment"><p>Mine came out flat. What did I do wrong? The dough was rather dry.</p></article>
<article class="comment"><p>Lovely bread, my family asked for more of it at once.</p></article></section></div>
<section class="sidebar"><h3>About me</h3><p>I bake and write. I live by the sea with two cats.</p><form><input><button>Search</button></form></section>
<footer>Powered by a small engine. <a href="/feed">Feed</a></footer></body></html>""",
    # An old page: a menu table, plain paragraphs, a disclaimer.
    """<html><body><div class="menu"><a href="1.html">One</a> | <a href="2.html">Two</a> | <a href="3.html">Three</a></div>
<div class="alert notice">This site will be down on Sunday night for maintenance, from ten to twelve.</div>
<div class="article-body" data-main="1"><h1>On sundials</h1><p>A sundial tells the hour by the place of a shadow.</p><p>The oldest are <a href="/egypt">Egyptian</a>, made of stone.</p>
<dl><dt>Gnomon</dt><dd>The part that casts the shadow.</dd></dl></div>
<div class="ads"><p>Cheap flights to the sun. Click here for the best offers of the year.</p></div>
<div id="legal" class="disclaimer">Nothing here is advice. We are not liable for clocks.</div></body></html>""",
    # A page with its main text in a section, popups, login and pagination.
    """<html><body><div class="modal popup"><p>Join our club today and read without limits for a month.</p><button>Join</button></div>
<div class="login"><form><label>Name</label><input><label>Password</label><input></form></div><div class="breadcrumbs"><a href="/">Home</a> &gt; <a href="/x">Guides</a></div>
<section class="main-text" data-main="1"><h1>Repairing a chair</h1><p>Look at the joints first. Loose joints are the most common fault, and easy to mend.</p>
<ol><li>Scrape off the old glue.</li><li>Glue, clamp and wait.</li></ol><p>Done.</p></section>
<div class="pagination"><a href="?2">2</a> <a href="?3">3</a> <a href="?4">Next</a></div>
<div class="sponsored"><h4>Sponsored</h4><p>Our partner makes the best clamps you can get for money.</p></div>
<div class="widget subscribe"><p>Get new guides by mail.</p></div><footer><ul><li><a href="/i">Imprint</a></li></ul></footer></body></html>""",
    # A bare fragment, as some feeds store it.
    """<div data-main="1"><p>The lake froze in December, and the whole village came to skate.</p><p>It thawed in March.</p></div>""",
    """<article data-main="1"><p>A short note.</p>And a tail of text outside any paragraph, as happens.</article>""",
    # Short prose full of links, in a content div: links are no sign of a menu here.
    """<html><body><div class="top"><a href="/">Home</a></div><div id="content" data-main="1"><h1>Rivers of the north</h1>
<p>See <a href="/a">the list of all rivers</a>, <a href="/b">their springs</a> and <a href="/c">their mouths</a>.</p>
<p><a href="/d">The Lune</a> joins <a href="/e">the Greta</a> at <a href="/f">Caton</a>.</p>
<ul><li><a href="/g">Lune</a>, 85 km</li><li><a href="/h">Greta</a></li><li><a href="/i">Wenning</a>, with <a href="/j">its five mills</a></li></ul>
<p><a href="/k">A longer account of every mill on the river, with maps</a></p></div>
<div class="footer"><a href="/imprint">Imprint</a> <a href="/terms">Terms of use</a></div></body></html>""",
    """<html><body><nav><ul><li><a href="/">Start</a></li></ul></nav><div class="main-content" data-main="1">
<p><a href="/x">Read the first part</a> before this one. It is short.</p><p>More in <a href="/y">the appendix</a>.</p></div></body></html>""",
    # An encyclopedia page: headings, tables and reference lists full of links belong to the article.
    """<html><body><div id="mw-head"><ul class="nav"><li><a href="/r">Read</a></li><li><a href="/e">Edit</a></li></ul></div>
<div id="bodyContent" data-main="1"><h1>Quartz</h1><p><b>Quartz</b> is a <a href="/m">mineral</a> of <a href="/s">silicon</a> and <a href="/o">oxygen</a>.</p>
<table><tr><th>Hardness</th><td>7</td></tr><tr><th>Group</th><td><a href="/t">tectosilicate</a></td></tr></table>
<h2>See also</h2><ul><li><a href="/am">Amethyst</a></li><li><a href="/ci">Citrine</a></li></ul></div>
<div id="footer"><p>This page was last edited in May. Text is available under a free licence; other terms may apply.</p></div></body></html>""",
    # A comment system of nested divs beside a post: prose as long as the post's, all of it off.
    """<html><body><div class="header"><a href="/">Blog</a></div><div class="post"><div class="article-header" data-main="1"><h1>On moss</h1></div>
<div class="article-text" data-main="1"><p>Moss grows where little else will. It needs shade, and water now and then.</p><p>It has no roots.</p></div></div>
<div id="disqus_thread"><div class="thread"><div><p>I never knew that moss has no roots, thank you for writing this. My wall is full of it.</p>
<p>Does it harm the stone?</p></div><div><p>No, it does not, as far as I know, and it looks very fine.</p></div></div></div></body></html>""",
    """<html><body><article data-main="1"><header><h1>Small boats</h1></header><div class="entry-content"><p>A small boat is slow, but it gets there.</p></div></article>
<div class="discussion"><ol><li><div class="comment-body"><p>We sailed one of these around the island, in two weeks, with no wind at all.</p></div></li>
<li><div class="comment-body"><p>Which island was it? I should like to try.</p></div></li></ol></div>
<div id="respond"><h3>Leave a reply</h3><form><p>Your address will not be shown. Required fields are marked.</p></form></div></body></html>""",
    # A post whose own head, title and date lie in a part named after a header; the site's header is off.
    """<html><body><div class="site-header"><h2>The reader</h2><p>Essays, twice a month, since 1998.</p></div><div class="main"><div class="post" data-main="1">
<div class="post-header"><h1>A defence of footnotes</h1><p>May 3, by R. Hale</p></div><p>They are where the book breathes. They are where it doubts.</p>
<p>Read them first.</p></div></div><div class="sidebar"><p>The reader is written by three friends, who share a desk and a kettle.</p></div></body></html>""",
    # Plain divs without telling names, the text straight in divs.
    """<html><body><div><a href="/">Home</a> <a href="/list">List</a></div><div data-main="1"><h1>Salt</h1><div>Salt was once worth its weight in silver, or so they say.</div>
<div>It keeps meat, and roads free of ice.</div></div><div>Copyright 2011. <a href="/c">Contact</a></div></body></html>""",
    # A page of a forum's news section: poll and tags beside the text.
    """<html><body><div id="nav"><a href="/f">Forum</a></div><main data-main="1"><h1>Rules of the fair</h1><p>Stalls open at eight. Dogs are welcome, on a lead.</p>
<div class="tags" data-off="1"><a href="/t/fair">fair</a> <a href="/t/dogs">dogs</a></div><p>No fires.</p></main>
<div class="related-posts"><h3>You may also like</h3><p><a href="/o">Last year's fair, in pictures and words by those who were there</a></p></div>
<div class="newsletter"><p>One letter a week, no more, with all that is new in the valley.</p></div></body></html>""",
)
