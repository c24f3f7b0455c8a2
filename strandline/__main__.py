import sys

from .service.cli import main

sys.exit(main())
