"""Pages written by hand in the manner of common sites, none with an article element: (name, html, blocks of main text)."""

PAGES = [
    ("neutral names", """<html><head><title>River ferry</title></head><body><div class="a1"><div class="a2"><a href="/">Home</a> <a href="/n">News</a> <a href="/c">Contact</a></div></div>
<div class="b1"><div class="b2"><h1>The ferry returns in spring</h1><p>After two years without a crossing, the ferry between the two villages will run again from April, the council said on Monday.</p>
<p>The old boat was sold in 2019. A smaller one, built in the yard upstream, carries twelve people and their bicycles.</p><p>Tickets cost two euros.</p></div></div>
<div class="c1"><p>&copy; 2024 Valley Media</p><a href="/i">Imprint</a></div></body></html>""",
     ["The ferry returns in spring", "After two years without a crossing, the ferry between the two villages will run again from April, the council said on Monday.",
      "The old boat was sold in 2019. A smaller one, built in the yard upstream, carries twelve people and their bicycles.", "Tickets cost two euros."]),
    ("table layout", """<html><body bgcolor="white"><table width="100%"><tr><td colspan="2"><a href="/"><img src="l.gif"></a> <a href="/a">About</a> | <a href="/l">Links</a> | <a href="/g">Guestbook</a></td></tr>
<tr><td valign="top" width="150"><a href="/1">Roses</a><br><a href="/2">Tulips</a><br><a href="/3">Lilies</a></td><td valign="top"><h2>Growing roses in clay soil</h2>
<p>Clay holds water well, which roses like, but it drains slowly, which they do not. Dig in plenty of compost before planting and raise the bed by a hand's width.</p>
<p>Prune in late February, once the worst frost is over. Cut above a bud that points outward.</p></td></tr><tr><td colspan="2" align="center"><font size="1">Copyright 2003 Anna's Garden Page</font></td></tr></table></body></html>""",
     ["Growing roses in clay soil", "Clay holds water well, which roses like, but it drains slowly, which they do not. Dig in plenty of compost before planting and raise the bed by a hand's width.",
      "Prune in late February, once the worst frost is over. Cut above a bud that points outward."]),
    ("wiki", """<html><body><div id="mw-navigation"><div class="portlet"><ul><li><a href="/m">Main page</a></li><li><a href="/r">Random page</a></li></ul></div></div>
<div id="content"><h1 id="firstHeading">Marsh harrier</h1><div id="bodyContent"><div id="mw-content-text"><p>The <b>marsh harrier</b> is a large <a href="/w/Harrier">harrier</a>, a bird of prey from temperate and subtropical western <a href="/w/Eurasia">Eurasia</a> and adjacent Africa.</p>
<h2>Description</h2><p>The male is mostly reddish-brown, with lighter streaking that shows on the breast. The female is almost entirely chocolate-brown.</p></div></div>
<div id="catlinks"><a href="/c">Categories</a>: <a href="/c/b">Birds of prey</a></div></div><div id="footer"><p>Text is available under a free licence; additional terms may apply.</p><ul><li><a href="/p">Privacy</a></li></ul></div></body></html>""",
     ["Marsh harrier", "The marsh harrier is a large harrier, a bird of prey from temperate and subtropical western Eurasia and adjacent Africa.", "Description",
      "The male is mostly reddish-brown, with lighter streaking that shows on the breast. The female is almost entirely chocolate-brown."]),
    ("blog", """<html><body><div id="header"><h1><a href="/">Slow Bread</a></h1><p class="tagline">Notes from a small kitchen</p></div><div id="content"><div class="post"><h2 class="entry-title">A rye loaf without kneading</h2>
<div class="entry-content"><p>Mix the flour, water and starter in the evening. Cover the bowl and leave it on the table overnight.</p><p>In the morning, shape the dough with wet hands and let it rest for an hour.</p>
<ul><li>500 g rye flour</li><li>400 g water</li><li>100 g starter</li></ul></div><div class="share"><a href="#">Tweet</a> <a href="#">Pin it</a></div></div>
<div id="comments"><h3>2 comments</h3><div class="comment"><p>Worked very well, thank you!</p></div><div class="comment"><p>Mine was a bit flat. More starter next time.</p></div></div></div>
<div id="sidebar"><h3>Recent posts</h3><ul><li><a href="/1">Plum jam</a></li><li><a href="/2">Oat biscuits</a></li></ul></div></body></html>""",
     ["A rye loaf without kneading", "Mix the flour, water and starter in the evening. Cover the bowl and leave it on the table overnight.", "In the morning, shape the dough with wet hands and let it rest for an hour.",
      "500 g rye flour", "400 g water", "100 g starter"]),
    ("plain body", """<html><head><title>Minutes</title></head><body><h1>Minutes of the spring meeting</h1><p>Present: nine members. The chair opened the meeting at seven.</p><p>The treasurer reported a balance of 412 euros. The report was accepted without a vote.</p>
<p>It was agreed to repair the boathouse roof before June.</p></body></html>""",
     ["Minutes of the spring meeting", "Present: nine members. The chair opened the meeting at seven.", "The treasurer reported a balance of 412 euros. The report was accepted without a vote.", "It was agreed to repair the boathouse roof before June."]),
    ("news in main", """<html><body><header><nav><ul><li><a href="/p">Politics</a></li><li><a href="/s">Sport</a></li></ul></nav></header><div class="cookie-banner"><p>We use cookies to improve your experience.</p><button>Accept</button></div>
<main><h1>Bridge closed for repairs until autumn</h1><p>The stone bridge on the north road will be closed to traffic from next week, the roads office announced.</p><div class="ad-slot"><span>Advertisement</span></div>
<p>Drivers are asked to use the bypass. Buses will stop at the mill instead of the market.</p></main><aside><h3>Most read</h3><ol><li><a href="/1">Storm damages pier</a></li></ol></aside><footer><p>All rights reserved.</p></footer></body></html>""",
     ["Bridge closed for repairs until autumn", "The stone bridge on the north road will be closed to traffic from next week, the roads office announced.", "Drivers are asked to use the bypass. Buses will stop at the mill instead of the market."]),
    ("manual", """<html><body><div class="toc"><ul><li><a href="#i">Install</a></li><li><a href="#u">Use</a></li></ul></div><div class="document"><div class="body"><h1>Command line</h1><p>The tool reads one file and writes its lines in order. With -r the order is reversed.</p>
<pre>sortlines -r names.txt</pre><p>Exit status is 1 where the file cannot be read.</p></div></div><div class="footer">Built on 3 May</div></body></html>""",
     ["Command line", "The tool reads one file and writes its lines in order. With -r the order is reversed.", "sortlines -r names.txt", "Exit status is 1 where the file cannot be read."]),
    ("utility classes", """<html><body><div class="flex p-4 bg-gray"><a class="px-2" href="/">Start</a><a class="px-2" href="/k">Kurse</a><a class="px-2" href="/t">Team</a></div><div class="max-w-xl mx-auto"><h1 class="text-2xl">Nähkurs für Anfänger</h1>
<p class="mb-4">Im Herbst beginnt ein neuer Kurs. An sechs Abenden lernen die Teilnehmer, eine Tasche und ein einfaches Kleid zu nähen.</p><p class="mb-4">Maschinen sind vorhanden, Stoffe bringt bitte jeder selbst mit.</p></div>
<div class="text-xs p-4"><a href="/impressum">Impressum</a> <a href="/datenschutz">Datenschutz</a></div></body></html>""",
     ["Nähkurs für Anfänger", "Im Herbst beginnt ein neuer Kurs. An sechs Abenden lernen die Teilnehmer, eine Tasche und ein einfaches Kleid zu nähen.", "Maschinen sind vorhanden, Stoffe bringt bitte jeder selbst mit."]),
]
