"""Reports: each public function takes entity frames and returns one DataFrame."""
