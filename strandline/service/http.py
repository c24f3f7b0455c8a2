"""HTTP: POST /query, GET /admin/jobs, GET /healthz, on the standard library's server."""

from __future__ import annotations

import hmac
import json
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from ..functions.config import QueryApi
from ..operators import query as Q
from ..streaming.scheduler import Registry
from .output import redact

LARGEST_BODY = 1 << 20


def server(api: QueryApi, service: Q.Service, registry: Registry | None = None) -> ThreadingHTTPServer:
    """Bound, not yet serving: call ``serve_forever``; ``shutdown`` ends it.

    401 without a known bearer key, 400 for a bad request or a statement the
    gate rejects, 408 past the deadline, 413 for too large a result, 422 for
    other errors of the query.
    """
    known = [k.encode() for k in api.keys]

    class Handler(BaseHTTPRequestHandler):
        def log_message(self, *args) -> None:  # statements may hold data
            pass

        def reply(self, status: int, body: str) -> None:
            data = body.encode()
            self.send_response(status)
            self.send_header("Content-Type", "application/json; charset=utf-8")
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def fail(self, status: int, why: str) -> None:
            self.reply(status, json.dumps({"error": redact(why, api.keys)}))

        def admitted(self) -> bool:
            kind, _, key = self.headers.get("Authorization", "").partition(" ")
            if kind.lower() == "bearer" and any([hmac.compare_digest(key.strip().encode(), k) for k in known]):
                return True
            self.fail(401, "a valid key is needed")
            return False

        def do_GET(self) -> None:
            if self.path == "/healthz":
                self.reply(200, json.dumps({"status": "ok"}))
            elif self.path != "/admin/jobs":
                self.fail(404, "no such address")
            elif self.admitted():
                self.reply(200, json.dumps({"jobs": registry.snapshot() if registry else []}, default=str))

        def do_POST(self) -> None:
            if self.path != "/query":
                self.fail(404, "no such address")
                return
            if not self.admitted():
                return
            try:
                size = int(self.headers.get("Content-Length", 0))
                if not 0 < size <= LARGEST_BODY:
                    raise ValueError
                body = json.loads(self.rfile.read(size))
                sql, rows, seconds = body["sql"], body.get("max_rows"), body.get("timeout_seconds")
                if not isinstance(sql, str) or any(x is not None and (isinstance(x, bool) or not isinstance(x, (int, float)) or x <= 0) for x in (rows, seconds)):
                    raise ValueError
            except (ValueError, KeyError, TypeError, AttributeError):
                self.fail(400, "the body must be JSON with sql and, if wanted, positive max_rows and timeout_seconds")
                return
            try:  # a request may lower the limits, never raise them
                done = service.run(sql, None if rows is None else max(1, int(rows)), service.timeout if seconds is None else min(seconds, service.timeout))
                self.reply(200, Q.to_json(done))
            except Q.Rejected as e:
                self.fail(400, str(e))
            except Q.Timeout as e:
                self.fail(408, str(e))
            except Q.TooLarge as e:
                self.fail(413, str(e))
            except Exception as e:  # whatever Spark says of the statement
                self.fail(422, str(e).splitlines()[0] if str(e) else type(e).__name__)

    host, _, port = api.listen.rpartition(":")
    return ThreadingHTTPServer((host, int(port)), Handler)
