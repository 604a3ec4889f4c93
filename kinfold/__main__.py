import json

from .cli import main

print(json.dumps(main(), default=float))
