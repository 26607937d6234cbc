"""Print log files: ``python -m planquill [options] FILE...``"""

from __future__ import annotations

import argparse
import sys

from planquill.functions import render
from planquill.sources import codec


def main(arguments: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="planquill", description=__doc__)
    p.add_argument("files", nargs="+")
    p.add_argument("-f", "--format", choices=["text", "json", "yaml", "xml"], default="text")
    kind = p.add_mutually_exclusive_group()
    kind.add_argument("--raw", action="store_true", help="everything that is stored, as JSON")
    kind.add_argument("--server-log", action="store_true", help="lines as a server's log has them")
    p.add_argument("--log-line-prefix", default="%m [%p] ")
    p.add_argument("--log-timezone", default="UTC")
    p.add_argument("--log-error-verbosity", choices=["terse", "default", "verbose"], default="default")
    p.add_argument("--verify-crc", action="store_true", help="check the sums that version 3 has")
    a = p.parse_args(arguments)
    records = []
    try:
        for path in a.files:
            with open(path, "rb") as f:
                records += codec.read_log(f.read(), path, a.verify_crc)
        if a.raw:
            out = "\n".join(map(render.to_raw, records))
        elif a.server_log:
            out = "\n".join(render.to_server_log(r, a.format, a.log_line_prefix, a.log_timezone, a.log_error_verbosity == "verbose") for r in records)
        elif a.format == "xml":
            out = render.xml_document([render.explained(r) for r in records])
        elif a.format == "json":
            out = render.to_json([render.explained(r) for r in records])
        elif a.format == "yaml":
            out = render.to_yaml([render.explained(r) for r in records])
        else:
            out = "\n\n".join(map(render.to_text, records))
    except (OSError, ValueError) as e:
        print(f"planquill: {e}", file=sys.stderr)
        return 1
    print(out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
