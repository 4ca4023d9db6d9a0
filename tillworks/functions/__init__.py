from tillworks.functions.rowops import *  # noqa: F401,F403
