"""The page a URL names, whatever its spelling."""

from __future__ import annotations

import html
import re
from urllib.parse import parse_qsl, quote, unquote, urlsplit

#: Parameters that follow a reader or change the display, not the page. Fixed values.
IGNORED = frozenset(
    "gclid fbclid msclkid dclid yclid mc_cid mc_eid xtor ref referrer referer from src source feed partner cmpid campaign phpsessid jsessionid aspsessionid "
    "sid sessionid session_id sess print printable amp output view display format mobile theme share".split()
)
_IGNORED_HEAD = ("utm_", "pk_", "piwik_", "mtm_", "hsa_", "_hs", "aspsessionid")
#: Parameters in which redirect wrappers carry their target. Fixed values.
TARGET = ("url", "u", "to", "target", "dest", "destination", "redirect", "link", "goto", "q")
_HOST_HEAD = re.compile(r"^(?:www\d?|m|mobile|amp|wap)\.(?=[^.]+\.[^.]+)")
_SESSION = re.compile(r";(?:jsessionid|phpsessid|sid)=[^/;?]*", re.I)


def page_key(url: str | None, depth: int = 3) -> str | None:
    """Canonical spelling of the page; None for no URL. Escapes are decoded, the host lower-cased, scheme,
    host prefix, default port, fragment, tracking, session and display parameters dropped, the others
    sorted, redirect wrappers opened. What can't be parsed names itself."""
    if url is None:
        return None
    text = html.unescape(url.strip(" \t\r\n "))
    text = re.sub(r"&(?:amp;)+", "&", text)
    if not text:
        return None
    try:
        if not re.match(r"[A-Za-z][A-Za-z0-9+.-]*://", text):
            text = "http://" + text.lstrip("/")
        parts = urlsplit(text)
        host = (parts.hostname or "").rstrip(".").lower()
        port = parts.port
    except ValueError:
        return text
    pairs = [(k.removeprefix("amp;").strip(), v.strip()) for k, v in parse_qsl(parts.query.replace(";", "&"), keep_blank_values=True)]
    if depth:
        for name in TARGET:
            for k, v in pairs:
                if k.lower() == name and re.match(r"https?(?:://|%3A)", v, re.I):
                    return page_key(unquote(v) if "://" not in v else v, depth - 1)
    while m := _HOST_HEAD.match(host):
        host = host[m.end() :]
    path = unquote(_SESSION.sub("", parts.path))
    path = re.sub(r"/{2,}", "/", path).rstrip("/")
    kept = sorted((k, v) for k, v in set(pairs) if k and k.lower() not in IGNORED and not k.lower().startswith(_IGNORED_HEAD))
    own = f":{port}" if port and port not in (80, 443) else ""
    return f"{host}{own}{path}" + ("?" + "&".join(f"{quote(k)}={quote(v)}" for k, v in kept) if kept else "")
