"""Names, patterns and word lists the results depend on."""

# --- fixed values: technique -> substrings of a rebuilt command line ---------
TECHNIQUES = {
    "T1003": ("cat /etc/shadow", "cat /etc/gshadow", "getent shadow", "dump"),
    "T1059": ("bash", "sh", "zsh", "python", "perl", "ruby", "php", "node"),
    "T1070": ("history -c", "rm /root/.bash_history", "shred", "wipe"),
    "T1071": ("curl", "wget", "ftp", "sftp"),
    "T1082": ("uname -a", "lscpu", "lshw", "dmidecode"),
    "T1087": ("who", "w", "last", "lastlog", "id", "getent passwd"),
    "T1105": ("scp", "rsync", "socat", "ncat"),
    "T1548": ("sudo", "su -", "pkexec"),
    "T1562": (
        "systemctl stop auditd",
        "service auditd stop",
        "auditctl -e 0",
        "setenforce 0",
    ),
}

# --- fixed values: syslog facility names by number ---------------------------
FACILITIES = (
    "kern", "user", "mail", "daemon", "auth", "syslog", "lpr", "news",
    "uucp", "cron", "authpriv", "ftp", "ntp", "audit", "alert", "clock",
    "local0", "local1", "local2", "local3", "local4", "local5", "local6", "local7",
)

# --- fixed values: syslog severity names by number ---------------------------
SEVERITIES = ("emerg", "alert", "crit", "err", "warning", "notice", "info", "debug")

# --- fixed values: programs and facilities dropped as noise, per profile -----
NOISE_NAMES_BASE = (
    "cron", "CRON", "systemd", "dbus", "dbus-daemon", "NetworkManager", "snapd",
    "polkitd", "packagekitd", "avahi-daemon", "cups", "gdm", "gnome-shell",
    "ModemManager", "wpa_supplicant",
)
NOISE_NAMES_SERVER = (
    "ntpd", "chronyd", "upstart", "init", "kernel", "dhclient", "dhcpcd",
    "postfix", "sendmail", "named", "bind", "apache2", "nginx", "mysqld", "postgres",
)
NOISE_FACILITIES_BASE = ("daemon", "kern", "cron", "lpr", "news", "uucp")
NOISE_PROFILES = {
    "universal": {
        "name": NOISE_NAMES_BASE,
        "prefix": ("systemd-",),
        "facility": NOISE_FACILITIES_BASE,
    },
    "debian": {
        "name": NOISE_NAMES_BASE + NOISE_NAMES_SERVER,
        "prefix": ("systemd-", "kernel:"),
        "facility": NOISE_FACILITIES_BASE + ("mail", "ftp"),
    },
    "rhel": {
        "name": NOISE_NAMES_BASE
        + tuple("httpd" if n == "apache2" else n for n in NOISE_NAMES_SERVER),
        "prefix": ("systemd-", "kernel:"),
        "facility": NOISE_FACILITIES_BASE + ("mail", "ftp"),
    },
    "manual": {"name": (), "prefix": (), "facility": ()},
}

# --- fixed values: programs and facilities kept as security relevant ---------
KEEP_NAMES = (
    "audit", "sshd", "sudo", "su", "login", "passwd", "useradd", "userdel", "usermod",
)
KEEP_FACILITIES = ("local3", "authpriv", "auth")
KEEP_PROFILES = {
    "universal": {"name": KEEP_NAMES, "facility": KEEP_FACILITIES},
    "debian": {"name": KEEP_NAMES, "facility": KEEP_FACILITIES},
    "rhel": {"name": KEEP_NAMES, "facility": KEEP_FACILITIES},
    "manual": {"name": (), "facility": ("local3",)},
}

# --- fixed values: programs the lookup filter ignores ------------------------
IGNORED_PROGRAMS = (
    "systemd", "systemd-resolved", "systemd-timesyncd", "systemd-networkd",
    "systemd-journald", "systemd-logind", "snapd", "packagekitd", "polkitd",
    "dbus", "dbus-daemon", "NetworkManager", "ModemManager", "wpa_supplicant",
    "avahi-daemon", "colord", "cups", "cups-browsed", "gnome-shell", "gdm",
    "udisks2", "rtkit-daemon", "accounts-daemon",
)

# --- fixed values: words that mark a message as security relevant ------------
SECURITY_KEYWORDS = (
    "FAILED", "ERROR", "denied", "unauthorized", "authentication", "security",
    "violation", "breach", "intrusion", "attack", "malware", "virus",
)

# --- fixed values: operational message texts ---------------------------------
NOISE_TEXTS = ("daemon start", "daemon stop", "unknown file")

# --- fixed values: programs a delivered log should not contain ---------------
UNWANTED_PROGRAMS = ("cron", "systemd", "dbus", "NetworkManager", "snapd", "kernel")

# --- fixed values: record types left out by the exclude list -----------------
EXCLUDED_TYPES = ("AVC", "CWD", "EOE", "CRYPTO_KEY_USER")

# --- fixed values: selector lines (selector, sink) ---------------------------
SELECTORS = (
    ("kern.warning", "kern.log"),
    ("auth,authpriv.*", "auth.log"),
    ("*.*;auth,authpriv.none", "syslog"),
    ("*.emerg", "all-users"),
    ("auth,authpriv.none", "syslog"),
)

# --- fixed values: id that stands for "not set" ------------------------------
UNSET_ID = 4294967295

# --- fixed values: audit architecture codes and x86 system call numbers ------
ARCH_CODES = {"c000003e": "b64", "40000003": "b32"}
SYSCALLS_B64 = {
    2: "open", 10: "mprotect", 41: "socket", 42: "connect", 43: "accept", 49: "bind",
    56: "clone", 57: "fork", 59: "execve", 62: "kill", 63: "uname", 76: "truncate",
    77: "ftruncate", 82: "rename", 83: "mkdir", 84: "rmdir", 85: "creat", 86: "link",
    87: "unlink", 88: "symlink", 90: "chmod", 91: "fchmod", 92: "chown", 93: "fchown",
    94: "lchown", 101: "ptrace", 105: "setuid", 106: "setgid", 113: "setreuid",
    114: "setregid", 133: "mknod", 159: "adjtimex", 164: "settimeofday", 165: "mount",
    166: "umount2", 170: "sethostname", 171: "setdomainname", 175: "init_module",
    176: "delete_module", 188: "setxattr", 189: "lsetxattr", 190: "fsetxattr",
    197: "removexattr", 198: "lremovexattr", 199: "fremovexattr", 227: "clock_settime",
    246: "kexec_load", 257: "openat", 259: "mknodat", 260: "fchownat", 263: "unlinkat",
    264: "renameat", 265: "linkat", 266: "symlinkat", 268: "fchmodat",
    304: "open_by_handle_at", 313: "finit_module", 322: "execveat",
}
SYSCALLS_B32 = {
    2: "fork", 5: "open", 8: "creat", 9: "link", 10: "unlink", 11: "execve",
    14: "mknod", 15: "chmod", 21: "mount", 22: "umount", 23: "setuid", 26: "ptrace",
    38: "rename", 46: "setgid", 52: "umount2", 70: "setreuid", 71: "setregid",
    74: "sethostname", 79: "settimeofday", 83: "symlink", 92: "truncate",
    93: "ftruncate", 94: "fchmod", 95: "fchown", 102: "socketcall",
    121: "setdomainname", 122: "uname", 124: "adjtimex", 128: "init_module",
    129: "delete_module", 182: "chown", 203: "setreuid32", 204: "setregid32",
    212: "chown32", 213: "setuid32", 214: "setgid32", 264: "clock_settime",
    283: "kexec_load", 295: "openat", 297: "mknodat", 298: "fchownat",
    301: "unlinkat", 302: "renameat", 303: "linkat", 304: "symlinkat",
    306: "fchmodat", 342: "open_by_handle_at", 350: "finit_module", 359: "socket",
    361: "bind", 362: "connect", 364: "accept4",
}

# --- fixed values: error names that rules use for exit codes -----------------
ERRNO = {
    "EPERM": 1, "ENOENT": 2, "EINTR": 4, "EIO": 5, "EBADF": 9, "EAGAIN": 11,
    "ENOMEM": 12, "EACCES": 13, "EBUSY": 16, "EEXIST": 17, "ENODEV": 19,
    "ENOTDIR": 20, "EISDIR": 21, "EINVAL": 22, "EROFS": 30,
}

# --- fixed values: account tools that rule files list as if system calls -----
NOT_SYSCALLS = (
    "useradd", "usermod", "userdel", "groupadd", "groupmod", "groupdel", "sys_kexec_load",
)
