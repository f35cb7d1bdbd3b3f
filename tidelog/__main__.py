import sys

from tidelog.cli import main

sys.exit(main())
