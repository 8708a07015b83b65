"""Pages whose layouts the labeller's generator never makes."""

WORDS = "the of and a to in is that it was for on are as with his they at be this from have or by one had not but what all were when we there can an your which their said if do will each about how up out them then she many some so these would other into has more her two like him see time could no make than first been its who now people my made over did down only way find use may water long little very after words called just where most know".split()
SHAPES = 6


def say(rng, low, high):
    return " ".join(rng.choice(WORDS) for _ in range(rng.randint(low, high))).capitalize() + "."


def page(rng, shape):
    """(html, texts of the main blocks) of one of the shapes."""
    want = []

    def main(tag, low=3, high=60):
        want.append(say(rng, low, high))
        return f"<{tag}>{want[-1]}</{tag}>"

    def other(tag, low=1, high=8):
        return f"<{tag}>{say(rng, low, high)}</{tag}>"

    def links(n):
        return "".join(f'<a href="/{i}">{rng.choice(WORDS)}</a> | ' for i in range(n))

    def menu():
        return "<ul>" + "".join(f"<li><a href=/{i}>{rng.choice(WORDS)}</a></li>" for i in range(rng.randint(3, 8))) + "</ul>"

    def part():
        r = rng.random()
        if r < 0.6:
            return main("p")
        if r < 0.7:
            return main("h2", 1, 6)
        if r < 0.8:
            return "<ul>" + "".join(main("li", 1, 14) for _ in range(rng.randint(1, 5))) + "</ul>"
        if r < 0.87:
            return "<table>" + "".join("<tr>" + "".join(main("td", 1, 4) for _ in range(3)) + "</tr>" for _ in range(2)) + "</table>"
        if r < 0.93:
            return "<blockquote>" + main("p", 5, 30) + "</blockquote>"
        return "<figure><img src=x>" + main("figcaption", 2, 12) + "</figure>"

    body = "\n".join([main("h1", 2, 9), *(part() for _ in range(rng.randint(2, 9)))])
    comments = "".join(f"<div class='comment-body'>{other('cite', 1, 2)}{other('p', 2, 30)}</div>" for _ in range(rng.randint(1, 5)))
    shapes = [
        f"<html><body><div id=top-header><div class=logo>{other('span', 1, 2)}</div><div id=main-menu>{menu()}</div></div><div id=wrapper class='site clearfix'><div id=primary class='content-area blog-body'>{body}</div><div id=secondary class='widget-area'><h3>{say(rng, 1, 2)}</h3>{menu()}</div></div><div id=bottom-footer>{other('p', 3, 12)}</div></body></html>",
        f"<body bgcolor=white><table width=100%><tr><td class=leftnav>{menu()}</td><td class=maincontent>{body}</td></tr></table><hr><center>{links(4)}</center></body>",
        f"<!doctype html><body class=home><div role=banner>{other('p', 1, 6)}</div><div role=navigation>{menu()}</div><div role=main>{body}</div><div role=complementary>{other('h3', 1, 3)}{menu()}</div><div role=contentinfo>{other('p', 2, 9)}</div>",
        f"<body><header class='page-head'><a href=/>{say(rng, 1, 2)}</a><nav>{menu()}</nav></header><main id=maincol><section class=article-wrap>{body}<aside class='pull-related'>{other('h4', 1, 3)}{menu()}</aside></section><section id=comments-section><h2>{say(rng, 1, 2)}</h2>{comments}</section></main><footer class=foot>{other('small', 2, 9)}</footer>",
        f"<body><div class='cookie-banner-wrap'>{other('p', 5, 20)}<button>{say(rng, 1, 1)}</button></div><div class=newsitem><div class=byline-share>{links(3)}</div>{body}</div><form action=/s class='newsletter-form'><label>{say(rng, 2, 6)}</label><input><button>Ok</button></form><div class=disclaimer-footer>{other('p', 4, 20)}</div>",
        f"<body><div class=outer><div class=hd>{menu()}</div><div class=bd><article itemprop=articleBody class='hentry'>{body}</article><div class='ad-slot sponsored-links'>{other('p', 3, 14)}{links(2)}</div></div><div class=ft>{links(5)}{other('p', 2, 8)}</div></div>",
    ]
    return shapes[shape], want
