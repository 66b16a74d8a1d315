"""FIXED VALUES: the small labelled table that the block classifier is trained on.

Each page is written for this table. A block of the article starts with '+', any
other with '-'; the marks are taken off before training.
"""

PAGES = [
    """<html><body><header><div class="logo">- The Daily Example</div><nav><ul><li><a href="/">- Home</a></li><li><a href="/w">- World</a></li></ul></nav></header>
<main><article><h1>+ Rivers rise after a week of rain</h1><p>+ Water levels rose again on Tuesday, and towns downstream prepared for more.</p><p>+ Nobody was hurt.</p>
<p>+ The <a href="/b">river board</a> said that the dams would hold for now, but it asked people to stay away from the banks.</p><ul><li>+ Take the upper road.</li><li>+ Keep pets inside.</li></ul></article>
<aside class="related"><h3>- Related</h3><ul><li><a href="/1">- Ten walks in the hills</a></li><li><a href="/2">- What is a flood plain?</a></li></ul></aside></main>
<footer><p>- Copyright 2020 The Daily Example. All rights reserved.</p><a href="/c">- Contact</a></footer></body></html>""",
    """<html><body><div id="top-menu"><a href="/a">- News</a> <a href="/b">Sports</a> <a href="/c">Weather</a></div><div class="cookie-notice">- We use cookies to make this site better for you. Read our policy to learn more about it.</div>
<div id="content"><h2>+ A short guide to bread</h2><p>+ Flour, water, salt.</p><p>+ Mix them and wait. Then fold the dough a few times, let it rise overnight in a cold place and bake it hot.</p><blockquote>+ Patience is the fifth ingredient.</blockquote></div>
<div class="comments"><h3>- 2 comments</h3><p>- I tried this on Sunday and it worked very well, thank you for the recipe!</p><p>- Mine was flat. Which flour did you use?</p></div>
<div id="footer">- Made with care in a small kitchen somewhere.</div></body></html>""",
    """<html><body><nav><ul><li><a href="/x">- one</a></li><li><a href="/y">- two</a></li></ul></nav><div class="ad">- Buy two and get the third one free, only today.</div>
<article><h1>+ Title of a page</h1><p>+ Word.</p><p>+ And.</p><p>+ A longer paragraph follows here, with enough words to be read as prose by anyone who looks.</p><p>+ End of it.</p></article><footer>- &copy; site, imprint</footer></body></html>""",
    """<html><body><div class="page"><div class="header">- My site</div><div class="menu"><a href="/1">- First</a><a href="/2">Second</a></div><div class="post"><h1>+ On maps</h1><p>+ A map is a picture of a place, and every map leaves something out.</p>
<p>+ That is its use.</p><div class="share"><a href="/t">- Tell</a> <a href="/f">a friend</a></div><p>+ Old maps show what people cared about when they were drawn, which is often taxes.</p></div><div class="sidebar"><h4>- About me</h4><p>- I write about maps and the people who make them, mostly on weekends.</p></div></div></body></html>""",
    """<html><body><form action="/search"><label>- Search this site</label></form><h1>+ Notes on frogs</h1><p>+ Frogs sing when it rains, and they sing louder when it has been dry for some time before.</p><p>+ Each kind has its own song, so a pond at night can be read like a list of names.</p>
<p>+ Some sleep all winter.</p><form><p>- Leave your email address and we will send you one letter a month.</p></form><p><a href="/1">- Older</a> <a href="/2">Newer</a></p></body></html>""",
    """<html><body><table><tr><td><a href="/a">- Start</a></td><td><a href="/b">- Archive</a></td><td><a href="/c">- Links</a></td></tr></table><div><p>+ This page has no classes at all, yet the long paragraphs in the middle of it are clearly what one came to read.</p>
<p>+ They follow each other without many links, as prose does, and they end with full stops.</p><p>+ Quite so.</p></div><div><a href="/1">- Terms</a> | <a href="/2">Privacy</a> | <a href="/3">Help</a></div></body></html>""",
    """<html><body><section id="main"><article><header><h1>+ Trains will run later</h1><p class="byline">- By A. Writer</p></header><p>+ From May the last train leaves at midnight, the company says, an hour later than it does now.</p><figure><figcaption>+ A train at the northern station.</figcaption></figure>
<div class="newsletter">- Get our news by mail every morning, free of charge.</div><p>+ Tickets cost the same.</p><section class="comments"><p>- Good news for those of us who work late, and about time too.</p></section></article></section><aside><p>- Most read today: five ways to sleep on a train without missing your stop.</p></aside></body></html>""",
    """<html><body><div class="alert">- Our offices stay closed on Monday.</div><div class="breadcrumb"><a href="/">- Home</a> / <a href="/d">Docs</a></div><main><h1>+ Setting the clock</h1><p>+ Press both keys.</p><p>+ Turn the wheel until the hour is right, then press again to keep it.</p><ol><li>+ Hours first</li><li>+ Minutes next</li></ol><pre>+ set 12:00</pre></main>
<div class="promo"><p>- Do you like this clock? The new model has a radio and a lamp, and it costs less.</p></div><div id="respond"><h3>- Leave a reply</h3></div></body></html>""",
    """<html><body><div class="banner">- Sale ends soon<article><h1>+ Inside a banner that was never closed</h1><p>+ The article still is the article, whatever was left open before it began.</p><p>+ Yes.</p></article><footer>- Imprint and contact</footer></body></html>""",
    """<html><body><aside><article><h3><a href="/1">- Another story</a></h3><p>- A teaser of a few words that leads elsewhere.</p></article></aside><article><h1>+ The story itself</h1><p>+ It is told here.</p><p>+ It has one more paragraph, a little longer than the first, and no links at all.</p></article></body></html>""",
    """<html><body><div class="article-body"><p>+ First words of a text in a plain container with a telling name.</p><p>+ Second.</p><table><tr><th>+ Year</th><th>+ Rain</th></tr><tr><td>+ 1990</td><td>+ 610 mm</td></tr></table><dl><dt>+ Sleet</dt><dd>+ Rain with some ice in it.</dd></dl></div>
<div class="tags"><a href="/r">- rain</a> <a href="/i">ice</a></div><div class="pagination"><a href="/2">- Next page</a></div><div class="footer-links"><a href="/l">- Legal</a></div></body></html>""",
    """<html><body><header><h1>- The Company</h1><p>- Tools for gardens since 1950.</p></header><div class="entry"><h2>+ How to prune a pear</h2><p>+ Wait for a dry day in late winter, before the buds swell.</p><p>+ Cut above a bud that looks outward. <a href="/p">See the pictures</a> for where.</p></div><footer><p>- We answer letters within a week, or as soon as the frost is over.</p></footer></body></html>""",
    """<html><body class="with-sidebar"><div><a href="/">- Home</a></div><div>- Example Online</div><div><h1>+ A walk along the old wall</h1><p>+ The wall was built to keep sheep out, not people, and it is low enough to step over nearly everywhere.</p><p>+ We followed it to the sea.</p>
<p>+ At the last farm a sign points to the <a href="/c">coast path</a>, which is the shorter way back if the tide is out.</p></div><div>- Share this</div><div>- Posted in <a href="/w">Walks</a></div><div>- 2020 Example Online Ltd</div></body></html>""",
    """<html><body><div role="navigation"><a href="/">- Start</a></div><div>- Menu</div><div>- Log in</div><p>+ Bees find their way by the sun, and on dull days by the light that clouds let through.</p><p>+ They dance it to each other.</p><p>+ How they correct for the time of day is still being studied, but they do.</p>
<div>- Read more</div><div><a href="/n">- Next: Wasps</a></div><div>- Powered by a small engine</div></body></html>""",
    """<html><body><article class="comment"><p>- I was there too, and it rained less than you say.</p></article><div class="commentList"><p>- First!</p></div><div class="siteFooter"><p>- We print on recycled paper.</p></div><main class="has-sidebar"><article><header><h1>+ Rain</h1></header><p>+ It fell</p><p>+ all day.</p></article></main></body></html>""",
    """<html><body><nav><ul><li><a href="/1">- One</a></li><li><a href="/2">- Two</a></li></ul></nav><article><h1>+ Words</h1><p>+ Ok</p><p><a href="/s">+ The whole paragraph is a link to its source</a></p><p>+ Hm</p><ul><li><a href="/k">+ Kites</a></li><li><a href="/l">+ Lanterns for the garden</a></li></ul><p>+ So</p>
<p><a href="/x">+ See</a></p><p><a href="/y">+ also</a></p><p>+ a b</p><h2><a href="/h">+ Heading</a></h2><p>+ c</p><p>+ Then two more words without an end</p><p><a href="/z">+ zinnia</a></p></article><div><a href="/3">- Three</a></div><footer><a href="/4">- Four</a></footer></body></html>""",
    """<html><body><div><a href="/0">- Zero</a></div><div class="content"><h2>+ Lists</h2><ul><li><a href="/a">+ Apples</a></li><li><a href="/b">+ Bananas and other fruit</a></li></ul><p>+ x</p><p><a href="/c">+ Cherry</a></p><p>+ End</p></div><div><a href="/9">- Nine</a></div></body></html>""",
    """<html><body><div class="story"><h1>+ Between the lines</h1><p>+ The first of the long paragraphs goes on for a while, so that the blocks around it look small beside its many words.</p><div class="ad">- Buy now</div><p>+ A second paragraph of the same length follows here, and it too holds more words than any of the notes put in between.</p><div class="notice">- This page was updated on Monday.</div><p>+ The first of the long paragraphs goes on for a while, so that the blocks around it look small beside its many words.</p><aside>- Also new here</aside><p>+ A second paragraph of the same length follows here, and it too holds more words than any of the notes put in between.</p><div class="promo"><p>- Only two left in stock.</p></div><p>+ The first of the long paragraphs goes on for a while, so that the blocks around it look small beside its many words.</p>
<nav>- Up, down</nav><p>+ A second paragraph of the same length follows here, and it too holds more words than any of the notes put in between.</p><form>- Your name</form><p>+ The first of the long paragraphs goes on for a while, so that the blocks around it look small beside its many words.</p></div><div class="comments"><p>- Well said</p><p>- A second paragraph of the same length follows here, and it too holds more words than any of the notes put in between.</p><p>- Agreed, and thanks.</p><p>- The first of the long paragraphs goes on for a while, so that the blocks around it look small beside its many words.</p><p>- Me too</p></div></body></html>""",
    """<html><body><article><p>+ A second paragraph of the same length follows here, and it too holds more words than any of the notes put in between.</p><div class="advert">- Half price</div><p>+ Short.</p><div class="ads">- The first of the long paragraphs goes on for a while, so that the blocks around it look small beside its many words.</div><p>+ The first of the long paragraphs goes on for a while, so that the blocks around it look small beside its many words.</p><p class="note disclaimer">- No liability.</p><p>+ A second paragraph of the same length follows here, and it too holds more words than any of the notes put in between.</p></article><aside><p>- A second paragraph of the same length follows here, and it too holds more words than any of the notes put in between.</p><p>- Small.</p><p>- The first of the long paragraphs goes on for a while, so that the blocks around it look small beside its many words.</p></aside></body></html>""",
]
